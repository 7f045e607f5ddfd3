"""Errors that a user can act on."""


class TesseraError(Exception):
    """Base of all."""


class SourceError(TesseraError):
    """An input breaks its contract."""


class ConstraintError(TesseraError):
    """Rows break constraints."""


class HierarchyError(TesseraError):
    """A hierarchy has a cycle, an orphan or a bad node."""


class CycleError(HierarchyError):
    """A hierarchy has a cycle."""


class StageError(TesseraError):
    """A stage can't start in a build's present state."""
