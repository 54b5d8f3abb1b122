"""Text helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the canonical 8-4-4-4-12 form. \z, because Java's $ also matches before a last newline.
UUID_PATTERN = r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_uuid(c) -> Column:
    """Lower-case id, or NULL when the text is not a canonical UUID.

    Lower-casing comes before deduplication, so two spellings of one id are one key.
    """
    c = _column(c)
    return F.when(is_uuid(c), F.lower(c))


def is_uuid(c) -> Column:
    """Whether the text is a canonical UUID; NULL for NULL."""
    return _column(c).rlike(UUID_PATTERN)


def is_present(c) -> Column:
    """True for text that is neither NULL nor blanks."""
    c = _column(c)
    return c.isNotNull() & (F.trim(c) != "")
