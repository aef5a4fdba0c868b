"""Failures the jobs raise on the driver."""


class LakeError(Exception):
    """Base class of every failure raised by this package."""


class DataValidationError(LakeError):
    """A blocking dataset gate failed."""


class DataProcessingError(LakeError):
    """A transformation step of a job failed."""


class WarehouseLoadError(LakeError):
    """A star-schema load was refused or failed; nothing of it is visible to readers."""
