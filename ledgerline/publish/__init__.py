from ledgerline.publish.refresh import Refresh, load_raw, refresh
from ledgerline.publish.target import resolve_target

__all__ = ["Refresh", "load_raw", "refresh", "resolve_target"]
