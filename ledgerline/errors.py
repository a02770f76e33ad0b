"""One exception per layer, so that a failed run names where it failed."""


class IngestError(RuntimeError):
    """The inputs are missing, malformed or of the wrong size; nothing was published."""


class RawValidationError(RuntimeError):
    """The raw copy does not match its source; the previous copy stays current."""


class MartContractError(RuntimeError):
    """A published contract is broken; the previous marts stay current."""
