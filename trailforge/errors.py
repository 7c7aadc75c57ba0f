"""The typed errors of the engine, each with a stable reason code."""


class EngineError(Exception):
    code = "engine"


class ConfigError(EngineError):
    code = "config"


class DatasetError(EngineError):
    code = "dataset"


class ValidationError(EngineError):
    code = "validation"


class TemplateError(EngineError):
    code = "template"


class StoreError(EngineError):
    code = "store"


class IdempotencyError(StoreError):
    code = "idempotency"


class HarnessError(EngineError):
    """Lost infrastructure; never counted as a model's failure."""

    code = "harness_error"
