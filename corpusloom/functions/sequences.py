"""Token sequences as array columns: truncate, append EOS, pad left, mask, label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.schemas import IGNORE_LABEL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _repeated(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value), times)


def pad_id_or_eos(pad_id: int | None, eos_id: int) -> int:
    """The pad token falls back to EOS when it is not set."""
    return eos_id if pad_id is None else pad_id


def truncate(ids: Column | str, max_length: int, n_special: int = 1) -> Column:
    """First ids of a sequence, leaving room for the special ids appended afterwards."""
    return F.slice(_col(ids), 1, max(max_length - n_special, 0))


def append_eos(ids: Column | str, eos_id: int) -> Column:
    return F.concat(_col(ids), F.array(F.lit(eos_id)))


def append_eos_pair(first: Column | str, second: Column | str, eos_id: int) -> Column:
    eos = F.array(F.lit(eos_id))
    return F.concat(_col(first), eos, _col(second), eos)


def left_pad(ids: Column | str, max_length: int, pad_id: int) -> Column:
    c = _col(ids)
    return F.concat(_repeated(pad_id, F.lit(max_length) - F.size(c)), c)


def attention_mask(ids: Column | str, max_length: int) -> Column:
    """0 on the padding of an unpadded sequence, 1 on its own positions."""
    both = F.concat(_repeated(0, F.lit(max_length)), _repeated(1, F.lit(max_length)))
    return F.slice(both, F.size(_col(ids)) + 1, F.lit(max_length))


def mask_labels(ids: Column | str, pad_id: int) -> Column:
    """Copy of the ids, ignored wherever the id is the pad id, genuine EOS included."""
    return F.transform(_col(ids), lambda i: F.when(i == pad_id, F.lit(IGNORE_LABEL)).otherwise(i))


def left_padded_labels(ids: Column | str, max_length: int, pad_id: int) -> Column:
    """Labels of the padded sequence.

    Most sequences hold the pad id only as their closing EOS, or not at all; those are copied by
    compiled code. Only the others need a look at every id, which Spark interprets.
    """
    c = _col(ids)
    n = F.size(c)
    padding = _repeated(IGNORE_LABEL, F.lit(max_length) - n)
    first_pad = F.array_position(c, F.lit(pad_id))
    closing = F.array(F.lit(IGNORE_LABEL))
    return (
        F.when(first_pad == 0, F.concat(padding, c))
        .when(first_pad == n, F.concat(padding, F.slice(c, F.lit(1), n - 1), closing))
        .otherwise(F.concat(padding, mask_labels(c, pad_id)))
    )


def supervised_count(ids: Column | str, pad_id: int) -> Column:
    """Labels left after masking; counted on the ids so that no label array is built."""
    return F.size(F.array_remove(_col(ids), F.lit(pad_id)))


def real_length(mask: Column | str) -> Column:
    """Positions an attention mask keeps."""
    return F.size(F.array_remove(_col(mask), F.lit(0)))


def rectangular(c: Column | str, max_length: int) -> Column:
    """The column itself; the job fails on a row whose length is not max_length."""
    value = _col(c)
    return F.when(F.size(value) == max_length, value).otherwise(
        F.raise_error(F.concat(F.lit(f"sequence length is not {max_length} but "), F.size(value).cast("string")))
    )
