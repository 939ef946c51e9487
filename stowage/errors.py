"""Errors raised by the library. All derive from :class:`StowageError`."""


class StowageError(Exception):
    """Base of every error raised here."""


class SpecError(StowageError, ValueError):
    """A table spec, disposition or setting that cannot be understood."""


class SchemaError(StowageError):
    """Base of the schema errors; carries the path of the offending field."""

    def __init__(self, message: str, path: str = ""):
        super().__init__(message)
        self.path = path


class UnsupportedTypeError(SchemaError):
    """A type that a table load cannot take."""


class NestedArrayError(UnsupportedTypeError):
    """An array directly inside an array; a table load refuses it."""


class NamespaceError(SchemaError):
    """A nested record would be staged with a namespace that starts with a dot."""


class MissingFieldError(SchemaError):
    """A required field of the target schema is missing in the source."""


class TypeMismatchError(SchemaError):
    """Source and target types differ; there are no silent casts."""


class UnionShapeError(SchemaError):
    """A union has another number of members than the target struct has fields."""


class SchemaMismatchError(SchemaError):
    """A frame to be saved has other columns than the existing table."""


class DuplicateColumnError(StowageError):
    """A result holds the same column name twice and cannot become a table."""


class TableNotFoundError(StowageError):
    """The table is not there, and the call may not create it."""


class TableExistsError(StowageError):
    """The name is taken already."""


class TableNotEmptyError(StowageError):
    """The destination holds rows and must not."""


class PartitioningError(StowageError):
    """A day was given for an unpartitioned table, or left out for a partitioned one."""


class ReadOnlyTableError(StowageError):
    """The table was not made by a save, so a save does not touch it."""


class OverlappingSaveError(StowageError):
    """Another save changed the destination meanwhile; this one has changed nothing."""
