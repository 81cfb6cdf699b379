"""What can stop a run; all of it is raised on the driver before anything is published."""


class PipelineError(Exception):
    """Any failure of a pipeline run."""


class InputError(PipelineError):
    """Inputs that break their contract."""


class SettingsError(PipelineError):
    """Missing or blank settings."""


class SchemaMismatch(PipelineError):
    """A table that doesn't have the columns and types it must have."""


class GuardError(PipelineError):
    """A write that would mix embedding models or versions."""


class WriteError(PipelineError):
    """A write whose result isn't what was staged."""
