"""What the engine raises, on the driver only."""


class EngineError(ValueError):
    """A refusal with a message for the user."""


class SchemaError(EngineError):
    """Columns that can't be bound to roles."""


class ManifestError(EngineError):
    """A plan or a manifest that can't be built as asked."""


class UrlListFormatError(EngineError):
    """A list of URLs that can't be read without guessing."""


class ContractError(EngineError):
    """A shard or its statistics break their contract."""
