"""Prompt builders (F3-F7, X3). Each returns a Column, so prompts stay inside Catalyst and
whole-stage codegen; a user's own builder is any ``Callable[[DataFrame], Column]``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PromptBuilder = Callable[[DataFrame], Column]

# ---- fixed values: prompt texts that must equal the reference's output byte for byte ----
PREAMBLE = "以下の参考情報から、質問に答えてください。\n\n"
QUESTION = "質問："
REFERENCE_INFO = "参考情報："
ANSWER = "回答："
POLICY = "回答の方針："
SLOT_OPEN = "（参考"
SLOT_CLOSE = "）"
EXTRACTIVE_CONTEXT = "Context:\n"
EXTRACTIVE_QUESTION = "Question:\n"
EXTRACTIVE_ANSWER = "Answer:\n"
# ---- end of fixed values ----

N_SLOTS = 5


def _s(c) -> Column:
    """Missing -> '' (nulls never render as text)."""
    if c is None:
        return F.lit("")
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def joint_text(c_in, c_out) -> Column:
    """input + output with no separator."""
    return F.concat(_s(c_in), _s(c_out))


def context_qa_prompt(instruction, context) -> Column:
    """preamble, question line, reference line, answer cue."""
    return F.concat(F.lit(PREAMBLE + QUESTION), _s(instruction), F.lit("\n" + REFERENCE_INFO), _s(context),
                    F.lit("\n\n" + ANSWER))


def multi_source_prompt(question, slots: Sequence[tuple], policy) -> Column:
    """question, then for slot i (1-based, number kept) with a non-empty source or context
    ``（参考i）src\\nctx\\n\\n``, then the answer policy and the answer cue. ``slots`` is a list
    of (source, context) column names/Columns/None; missing columns behave as empty."""
    parts = [F.lit(PREAMBLE + QUESTION), _s(question), F.lit("\n\n" + REFERENCE_INFO + "\n")]
    for i, (src, ctx) in enumerate(slots, start=1):
        s, c = _s(src), _s(ctx)
        block = F.concat(F.lit(f"{SLOT_OPEN}{i}{SLOT_CLOSE}"), s, F.lit("\n"), c, F.lit("\n\n"))
        parts.append(F.when((s != "") | (c != ""), block).otherwise(F.lit("")))
    parts += [F.lit(POLICY), _s(policy), F.lit("\n\n" + ANSWER)]
    return F.concat(*parts)


def own_qa_slots(df: DataFrame, n: int = N_SLOTS) -> list[tuple]:
    """(Source_i, Context_i) column names present in ``df``; absent ones are None."""
    cols = set(df.columns)
    return [(f"Source_{i}" if f"Source_{i}" in cols else None, f"Context_{i}" if f"Context_{i}" in cols else None)
            for i in range(1, n + 1)]


def own_qa_prompt(df: DataFrame) -> Column:
    """F5 over an own-QA table (Input, Source_1..5, Context_1..5, Context_know-how)."""
    policy = "Context_know-how" if "Context_know-how" in df.columns else None
    return multi_source_prompt("Input" if "Input" in df.columns else None, own_qa_slots(df), policy)


def flatten_context(c) -> Column:
    """each item ``title\\n`` + sentences joined by one space; items joined by a blank line; null items
    are ignored. Items are structs (title, sentences); see ``flatten_context_pairs`` for arrays."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(
        F.transform(F.filter(col, lambda x: x.isNotNull()),
                    lambda x: F.concat(_s(x["title"]), F.lit("\n"),
                                       F.array_join(F.coalesce(x["sentences"], F.array().cast("array<string>")), " "))),
        "\n\n")


def flatten_context_pairs(c) -> Column:
    """F6 for items given as arrays [title, paragraph, ...]; null items and items of fewer than two
    elements are ignored."""
    col = F.col(c) if isinstance(c, str) else c
    kept = F.filter(col, lambda x: F.size(F.coalesce(x, F.array().cast("array<string>"))) >= 2)
    return F.array_join(F.transform(kept, lambda x: F.concat(_s(x[0]), F.lit("\n"), _s(x[1]))), "\n\n")


def extractive_prompt(context, question, answer) -> Column:
    """Context / Question / Answer block, the answer included."""
    return F.concat(F.lit(EXTRACTIVE_CONTEXT), _s(context), F.lit("\n" + EXTRACTIVE_QUESTION), _s(question),
                    F.lit("\n" + EXTRACTIVE_ANSWER), _s(answer))
