"""Token sequences as array columns: shaping, masks and label scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally import fixed_values as V


def _room(seq: Column, length: Column) -> Column:
    return F.greatest(F.lit(0), length - F.size(seq))


def truncate_tokens(ids: Column, max_length: int = V.MAX_LENGTH) -> Column:
    return F.slice(ids, 1, max_length)


def pad_left(ids: Column, pad_id: int, max_length: int = V.MAX_LENGTH) -> Column:
    return F.concat(F.array_repeat(F.lit(pad_id), _room(ids, F.lit(max_length))), ids)


def pad_right(ids: Column, pad_id: int, length: Column) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), _room(ids, length)))


def attention_mask(ids: Column, max_length: int = V.MAX_LENGTH) -> Column:
    """Mask of ``ids`` once padded on the left: from the length, so no id is mistaken for padding."""
    return F.concat(
        F.array_repeat(F.lit(0), _room(ids, F.lit(max_length))),
        F.array_repeat(F.lit(1), F.size(ids)),
    )


def mask_from_ids(ids: Column, pad_id: int) -> Column:
    """Mask of everything that differs from the padding id, genuine end tokens included."""
    return F.transform(ids, lambda x: (x != F.lit(pad_id)).cast("int"))


def completion_slice(ids: Column, prompt_length: Column) -> Column:
    return F.slice(ids, prompt_length + 1, F.greatest(F.lit(0), F.size(ids) - prompt_length))


def drop_special(ids: Column, special_ids: list[int]) -> Column:
    return F.filter(ids, lambda x: ~x.isin(special_ids))


def _log_norm(logits: Column) -> Column:
    """One-element array with ``ln(sum(exp(logits)))``, shifted by the maximum against overflow.

    Values used inside a lambda are bound as lambda variables over a one-element
    array: a plain outer expression would be worked out again for every element,
    which makes the whole thing quadratic in the vocabulary.
    """
    top = F.array(F.array_max(logits).cast("double"))

    def total(m: Column) -> Column:
        return F.aggregate(
            logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - m)
        )

    return F.transform(top, lambda m: m + F.ln(total(m)))


def log_softmax(logits: Column) -> Column:
    """Log-probabilities over the vocabulary."""
    return F.flatten(
        F.transform(
            _log_norm(logits),
            lambda z: F.transform(logits, lambda x: x.cast("double") - z),
        )
    )


def label_logprob(logits: Column, label: Column) -> Column:
    """Log-softmax at the label only; the full vector is never built."""
    return gather_label(logits, label).cast("double") - F.element_at(_log_norm(logits), 1)


def gather_label(scores: Column, label: Column) -> Column:
    """Score of a 0-based label id; NULL when the id is outside the vocabulary."""
    return F.try_element_at(scores, label + 1)


def shift_labels(scores: Column, ids: Column) -> Column:
    """Scores at position t with the token at t + 1, as an array of (score, label)."""
    short = F.greatest(F.lit(0), F.size(ids) - 1)
    return F.arrays_zip(
        F.slice(scores, 1, short).alias("score"), F.slice(ids, 2, short).alias("label")
    )


def in_loss(pos: Column, prompt_length: Column, seq_length: Column | None = None) -> Column:
    """0/1 loss mask at a shifted position. Padding past an early end stays in unless
    ``seq_length`` is given."""
    keep = pos >= prompt_length - 1
    if seq_length is not None:
        keep = keep & (pos < seq_length)
    return keep.cast("int")


def loss_mask(length: Column, prompt_length: Column) -> Column:
    """Loss mask of ``length`` shifted positions as one array."""
    hidden = F.least(length, F.greatest(F.lit(0), prompt_length - 1))
    return F.concat(
        F.array_repeat(F.lit(0), hidden),
        F.array_repeat(F.lit(1), F.greatest(F.lit(0), length - hidden)),
    )
