"""Token ids and labels as array expressions.

Ids are ``array<int>`` columns. The built-in backend is a code-point tokeniser that runs as
plain SQL (one id per Unicode code point, no special tokens); a user tokenizer runs through
``functions.tokenizer`` (an Arrow UDF) and yields the same column type, so every
function here works with either backend.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE_INDEX = -100  # label value that the loss ignores


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_int(v) -> Column:
    return v if isinstance(v, Column) else F.lit(int(v))


def _chars(text, max_len: int | None = None) -> Column:
    """One string per code point, of the first ``max_len`` only: the text is cut before it is split."""
    t = F.coalesce(_c(text), F.lit(""))
    return F.split(t if max_len is None else F.substring(t, 1, int(max_len)), "")


def codepoint_ids(text, max_len: int | None = None) -> Column:
    """Code-point tokeniser: one id per code point (``split`` on the empty pattern yields whole
    code points, supplementary characters included); null or empty text gives [].

    With ``max_len`` the result equals ``codepoint_ids(text)[:max_len]``: every id depends on its
    own character only, so only the characters that reach the output are mapped."""
    chars = _chars(text, max_len)
    if max_len == 0:
        return F.array().cast("array<int>")
    return F.when(F.length(F.coalesce(_c(text), F.lit(""))) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(chars, lambda ch: F.ascii(ch)))


def codepoint_count(text) -> Column:
    """Number of code-point tokens of the whole text (= size(codepoint_ids(text)))."""
    return F.length(F.coalesce(_c(text), F.lit("")))


def encode_segment(text, tokenize=None) -> Column:
    """ids of one segment without special tokens (code points unless a tokenize function
    such as ``functools.partial(tokenizer_ids, spark, tokenizer_json=...)`` is given)."""
    return codepoint_ids(text) if tokenize is None else tokenize(text)


def pad_or_eos(pad: int | None, eos: int) -> int:
    """the pad id falls back to the eos id when the tokenizer defines none."""
    return eos if pad is None else pad


def truncate_right(ids, n) -> Column:
    """the first n elements."""
    return F.slice(_c(ids), 1, _lit_int(n))


def pad_right(ids, n, pad) -> Column:
    """Pad with ``pad`` on the right up to length n (no truncation)."""
    a = _c(ids)
    return F.concat(a, F.array_repeat(_lit_int(pad), F.greatest(_lit_int(n) - F.size(a), F.lit(0))))


def encode_fixed(ids, max_len: int, pad: int) -> tuple[Column, Column]:
    """truncate right to max_len, pad right to max_len; returns (input_ids, attention_mask)."""
    t = truncate_right(ids, max_len)
    n = F.size(t)
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(int(max_len)) - n))
    return pad_right(t, max_len, pad), mask


def append_eos(ids, eos: int) -> Column:
    """end-of-sequence id appended (to the answer)."""
    return F.concat(_c(ids), F.array(F.lit(int(eos))))


def label_answer_only(prompt_ids, answer_ids) -> Column:
    """-100 for every prompt token, then the answer ids."""
    return F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size(_c(prompt_ids))), _c(answer_ids))


def label_all(ids, mask=None, mask_pad: bool = True) -> Column:
    """labels = ids; with ``mask_pad`` positions whose attention mask is 0 get -100."""
    if not mask_pad or mask is None:
        return _c(ids)
    i, m = _c(ids), _c(mask)
    each = F.transform(i, lambda x, at: F.when(F.element_at(m, at + 1) == 1, x).otherwise(F.lit(IGNORE_INDEX)))
    # A mask of ones and then zeros, as encode_fixed makes it, needs no step per element.
    first = F.array_position(m, 0).cast("int")
    n = F.when(first == 0, F.size(m)).otherwise(first - 1)
    ones_first = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.size(m) - n))
    return F.when((F.size(i) == F.size(m)) & (m == ones_first),
                  F.concat(F.slice(i, 1, n), F.array_repeat(F.lit(IGNORE_INDEX), F.size(i) - n))).otherwise(each)


def label_joint(ids, n_prompt, max_len: int) -> Column:
    """F16: -100 x n_prompt, then ids from position n_prompt on, cut to max_len."""
    n = _lit_int(n_prompt)
    return F.slice(F.concat(F.array_repeat(F.lit(IGNORE_INDEX), n), F.slice(_c(ids), n + 1, F.lit(int(max_len)))),
                   1, int(max_len))


def non_pad_count(ids, pad: int) -> Column:
    """A3: number of ids different from the pad id."""
    return F.size(F.filter(_c(ids), lambda x: x != F.lit(int(pad))))


def label_after_prompt(ids, answer_ids, pad: int, max_len: int) -> Column:
    """length max_len of -100 with the answer ids written from the non-pad count onward."""
    n = non_pad_count(ids, pad)
    a = F.slice(_c(answer_ids), 1, int(max_len))
    return F.slice(F.concat(F.array_repeat(F.lit(IGNORE_INDEX), n), a,
                            F.array_repeat(F.lit(IGNORE_INDEX), F.lit(int(max_len)))), 1, int(max_len))


def n_supervised(labels) -> Column:
    """Number of positions that carry a label (not -100)."""
    return F.size(F.filter(_c(labels), lambda x: x != F.lit(IGNORE_INDEX)))


def ids_text(ids) -> Column:
    """Comma-joined ids (for reports and comparisons). Padding, the last id as often as it ends the array, is
    written as a repeated text; only what stands before it is joined id by id."""
    a = _c(ids)
    pad = F.try_element_at(a, F.lit(-1))
    n = F.size(F.array_remove(a, pad))
    times = F.size(a) - n
    head = F.array_join(F.slice(a, 1, n), ",")
    one = pad.cast("string")
    padded = F.concat_ws(",", F.when(head != "", head), F.concat(F.repeat(F.concat(one, F.lit(",")), times - 1), one))
    return F.when(F.slice(a, n + 1, times) == F.array_repeat(pad, times), padded).otherwise(F.array_join(a, ","))
