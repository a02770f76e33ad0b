"""A full refresh: load raw, prove it, build, check what was written, publish.

Every attempt writes to folders of its own, also a retry under the same run id; what is current
changes only after every error-severity check has passed. A failed attempt removes what it wrote.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ledgerline.errors import IngestError, MartContractError, RawValidationError
from ledgerline.models import Models
from ledgerline.operators import with_row_id
from ledgerline.publish.target import resolve_target
from ledgerline.publish.versions import Versions
from ledgerline.quality import reconcile
from ledgerline.quality.checks import ERROR, Check, summarise
from ledgerline.quality.rules import all_checks, quarantine_has_ids
from ledgerline.schemas import RAW_TABLES
from ledgerline.session import configure
from ledgerline.sources.contract import conform

# Published runs that stay readable, per target and of raw.
KEEP_RUNS = 3

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Refresh:
    """What a run did."""

    run_id: str
    target: str
    raw_counts: dict[str, dict]
    checks: DataFrame
    published: tuple[str, ...]


def load_raw(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    base: str,
    run_id: str,
    expected_rows: dict[str, int] | None = None,
    attempt: str | None = None,
    source_counts: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, dict], dict[str, DataFrame]]:
    """Replace the raw tables by an exact copy of the sources, all of them or none.

    Rows are neither deduplicated nor cleaned. Before anything is read, each source is counted on its
    own: by a row of `source_counts` (n_rows, n_keys), which a database computes where it is, or else
    by a pass over the source. The copy is read back and compared with that count and with what its
    write observed before it becomes current. Returns the counts and the copy.

    Whoever goes on to read the copy takes a lease on `attempt` first.
    """
    missing = sorted(set(RAW_TABLES) - set(sources))
    if missing:
        raise IngestError(f"no source for {missing}")
    versions = Versions(spark, f"{base}/raw")
    attempt = attempt or versions.new_attempt(run_id)
    try:
        written, observed, counted = {}, {}, {}
        for name, table in RAW_TABLES.items():
            try:
                frame = (source_counts or {}).get(name)
                frame = reconcile.profile(sources[name], table.key) if frame is None else frame
                counted[name] = frame.select("n_rows", "n_keys").first().asDict()
            except (PySparkException, Py4JJavaError) as e:
                raise IngestError(f"{name}: cannot be counted") from e
        for name, table in RAW_TABLES.items():
            observed[name] = reconcile.fingerprint(table.key)
            try:
                source = with_row_id(conform(sources[name], table), table.columns)
                written[name] = versions.stage(source, attempt, name, observed[name])
            except (PySparkException, Py4JJavaError) as e:
                raise IngestError(f"{name}: cannot be loaded") from e

        report, counts = reconcile.differences(
            observed, lambda name: spark.read.parquet(versions.path(attempt, name)), counted
        )
        if report:
            raise RawValidationError("; ".join(report))
        wrong = [
            f"{name}: expected {expected} rows, found {counts[name]['n_rows']}"
            for name, expected in (expected_rows or {}).items()
            if counts[name]["n_rows"] != expected
        ]
        if wrong:
            raise IngestError("; ".join(wrong))
    except Exception:
        versions.discard(attempt)
        raise
    versions.publish(run_id, attempt, list(RAW_TABLES))
    return counts, written


def refresh(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    base: str,
    *,
    target: str | None = None,
    run_conf: dict[str, str] | None = None,
    as_of: dt.date | str | None = None,
    run_id: str | None = None,
    rates: DataFrame | None = None,
    normalize_keys: bool = False,
    expected_rows: dict[str, int] | None = None,
    extra_checks: list[Check] | None = None,
    keep_runs: int = KEEP_RUNS,
    source_counts: dict[str, DataFrame] | None = None,
) -> Refresh:
    """Load, build, check and publish one run below `base`, a folder all executors can reach.

    Raw is shared by all targets; marts and issue tables are published per target, and built from the
    copy of raw that this run wrote. Relations that several others read are written once and read
    back, so no mart recomputes them and the loss of an executor costs no more than the tasks it was
    running; they go when the run is published. The last `keep_runs` published runs are kept.
    """
    configure(spark)
    base, target = base.rstrip("/"), resolve_target(target, run_conf)
    run_id = run_id or uuid.uuid4().hex
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    versions, raw_versions = Versions(spark, f"{base}/{target}"), Versions(spark, f"{base}/raw")
    versions.create_views(f"billing_{target}")
    raw_attempt, attempt = raw_versions.new_attempt(run_id), versions.new_attempt(run_id)
    # Other runs, of this target or another, replace raw meanwhile, and may be through first.
    with raw_versions.lease(raw_attempt), versions.lease(attempt):
        counts, raw = load_raw(
            spark, sources, base, run_id, expected_rows, raw_attempt, source_counts
        )
        models = Models(
            raw,
            as_of,
            rates=rates,
            normalize_keys=normalize_keys,
            # So the checks read the marts as written, not the plans that wrote them.
            keep=lambda df, name: versions.stage(df, attempt, name),
        )
        try:
            models.build_together()
            checks = all_checks(models) + [quarantine_has_ids(models.issues_invoices)]
            checks += extra_checks or []
            summary = versions.stage(summarise(checks), attempt, "check_results")
            failed = summary.where(summary.outcome == ERROR).select("check_name", "failures").collect()
            if failed:
                named = ", ".join(f"{r['check_name']} ({r['failures']})" for r in failed)
                raise MartContractError(f"not published: {named}")
        except Exception:
            versions.discard(attempt)
            raise
        published = (*models.marts, *models.issue_tables)
        versions.publish(run_id, attempt, list(published))
        versions.discard(attempt, keep=(*published, "check_results"))
    versions.create_views(f"billing_{target}")
    for each in (versions, raw_versions):
        each.retain(keep_runs)
    versions.drop_old_databases(f"billing_{target}")
    log.info("run %s published %s to %s", run_id, ", ".join(published), target)
    return Refresh(run_id, target, counts, summary, published)
