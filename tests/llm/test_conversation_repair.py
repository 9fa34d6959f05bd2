import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tuneforge.llm import conversation_repair as R
from tuneforge.llm import queries

from ..conftest import SF_SMALL

GOOD = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """(blank, again, truncated) of a conversation's rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        blank = not bare
        again = not blank and (role, text) in seen
        seen.add((role, text))
        out.append((blank, again, not blank and not again and bare[-1] not in ".!?"))
    return out


def cheapest(rows):
    """(cost, audit, lines): of all edits, tried row by row; kept for each (roles so far end in) the least audit."""
    best = {"": (0, "", ())}  # last initial of the result -> (cost, audit, lines)

    def better(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(2):
            for last, (cost, audit, lines) in list(table.items()):
                better(table, follow[last], (cost + 3, audit + "I", (*lines, name[follow[last]] + ":")))
        return table

    for (_, role, text), (blank, again, cut) in zip(rows, faults(rows)):
        after = {}
        for last, (cost, audit, lines) in inserted(best).items():
            better(after, last, (cost + 4, audit + "D", lines))
            if not blank and not again:
                extra, to = 3 * cut, follow[last]
                better(after, to, (cost + 3 + extra, audit + "R", (*lines, f"{name[to]}:{text}")))
                if role[:1] == to or (role[:1], last) == ("s", ""):
                    better(after, role[:1], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
        best = after
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def expected(original, rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv in {r[0] for r in original}:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        marks, turns = faults(own), [t for t, _, _ in own if t is not None]
        cost, audit, lines = cheapest(own)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(m[i] for m in marks) for i in range(3)],
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, audit string, n int")


ROLES = ["system", "user", "assistant", "assistant", "user", "tool", "", "sue", None, "User", "ünder"]


def conversation(rng, conv, n, turns=None):
    texts = ["a.", "b!", "c?", "open", "", " \t", None, "ä. \n", "x" * 3000, "line\nbreak."]
    return [(conv, rng.choice([t, t, t, t + 1, None]), rng.choice(ROLES), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}" + rng.choice(["", ".", "?"]))
            for t in (turns or range(n))]


@pytest.fixture(params=[(10, 10), (1, 1), (2, 1)], ids=["large pieces", "pieces of 2", "pieces of 4"])
def sizes(request, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BITS", request.param[0])
    monkeypatch.setattr(R, "FAN_BITS", request.param[1])


def test_brute_force(spark, sizes):
    rng = random.Random(7)
    rows = list(itertools.chain.from_iterable(conversation(rng, i, rng.choice([1, 2, 3, 5, 8, 13])) for i in range(60)))
    rows += conversation(rng, None, 9) + [(900, None, None, None), (901, 5, "user", "q."), (902, -3, "assistant", "ok."), (902, 9, "system", "s.")]
    rows += [(903, 1, "user", "same.")] * 40 + [(903, 2, "assistant", "more.")] + conversation(rng, 904, 300)
    got = R.repair_all(table(spark, rows), table(spark, rows).repartition(3))
    assert result(got) == expected(rows, rows)


def test_damaged(spark):
    rng = random.Random(9)
    rows = list(itertools.chain.from_iterable(conversation(rng, i, 6) for i in [*range(40), None]))
    rows += [(c, 0, "user", "gone.") for c in range(1000, 1100)]  # some have no row left
    bad = damaged(rows)
    assert {r[0] for r in rows} - {r[0] for r in bad}
    got = R.damage(table(spark, rows))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, bad))
    assert result(R.repair_all(table(spark, rows), got)) == expected(rows, bad)
    assert R.repair_all(table(spark, []), R.damage(table(spark, []))).collect() == []


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(queries.op13_conversation_repair(spark, SF_SMALL))
    assert got == expected(rows, damaged(rows))
    for r in got:  # the audit gives the form
        assert len(r[7]) - r[7].count("I") == sum(x[0] == r[0] for x in damaged(rows))


def test_ranks_order_audits():
    """Ranks by doubled lengths order the nodes as their least audits do, and every arc chosen is optimal."""
    rng = np.random.default_rng(1)
    lens = rng.integers(1, 40, 30)
    p = R.Pieces(rng.integers(0, 12, lens.sum()), lens)
    ends = np.tile(R.FINAL, (len(lens), 1))
    letter, rank, pointers, left = p.ranked(ends)
    audits = [p.audits(ends, np.full(len(lens), q)) for q in range(4)]
    first = [(audits[q][i], rank[p.base[i] + q]) for i in range(len(lens)) for q in range(4)]
    for (a, ra), (b, rb) in itertools.pairwise(sorted(first)):
        assert (ra < rb) == (a < b) and (ra == rb) == (a == b)
    assert max(left) <= 2 ** (len(pointers) - 1) * 1 or (letter[pointers[-1]] == 0).all()


def test_every_audit_by_enumeration():
    """Against all edits of short conversations, written out."""
    rng = random.Random(11)
    for _ in range(60):
        rows = [(t, rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", "", "c."])) for t in range(rng.randint(0, 3))]
        best = None
        marks = faults(rows)
        for plan in itertools.product(itertools.product(["", "u", "a", "ua", "au"], ["D", "K", "Ru", "Ra"]), repeat=len(rows)):
            for end in ("", "u", "a", "ua", "au"):
                cost, audit, form, ok = 3 * len(end), "", "", True
                for (ins, e), (_, role, _), (blank, again, cut) in zip(plan, rows, marks):
                    ok &= e == "D" or not (blank or again)
                    cost += 3 * len(ins) + (4 if e == "D" else 3 * (e != "K") + 3 * cut)
                    audit += "I" * len(ins) + e[0]
                    form += ins + {"D": "", "K": role[:1]}.get(e, e[-1])
                if ok and GOOD.fullmatch(form + end):
                    best = min(best or (cost, audit + "I" * len(end)), (cost, audit + "I" * len(end)))
        assert cheapest(rows)[:2] == best
