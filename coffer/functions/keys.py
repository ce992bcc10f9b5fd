"""Row identity."""

from pyspark.sql import functions as F

from coffer.schemas import GRAIN


def key_text(*names):
    """Unambiguous text of a composite key with NULLs.

    Each part is prefixed by its length, so no value can imitate a separator,
    and NULL differs from every text.
    """
    texts = [f"CAST({name} AS STRING)" for name in names]
    parts = [f"coalesce(concat(length({t}), ':', {t}), 'n')" for t in texts]
    return F.expr(f"concat_ws('|', {', '.join(parts)})")


def entry_id(*names):
    """Reproducible id of a fact row: hash of its grain, stable under task retries."""
    return F.md5(key_text(*(names or GRAIN)))


def moved_id(name, *grain):
    """An id without what its grain tells: ``(is the hash of its grain, the id if it is any other)``.

    For rows that move: their grain moves anyway, and most ids are its hash, which
    :func:`restored_id` makes again.  Any other id moves as it is.
    """
    own = F.coalesce(F.col(name) == entry_id(*grain), F.lit(False))
    return own, F.when(~own, F.col(name))


def restored_id(is_own, other, *grain):
    """The id that :func:`moved_id` took apart."""
    return F.when(is_own, entry_id(*grain)).otherwise(other)


def random_entry_id():
    """A random id, as an option for users who want ids unrelated to content."""
    return F.uuid()
