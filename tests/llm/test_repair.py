import hashlib
import random
import re
import zlib

import pytest

from starfit.llm import repair
from starfit.llm.queries import QUERIES

GOOD = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\v\f\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def faults_of(rows):
    """B, D, T or K for every (role, text)."""
    out = []
    for k, (role, text) in enumerate(rows):
        bare = text.rstrip(BLANK)
        out.append("B" if not bare else "D" if (role, text) in rows[:k] else "K" if bare[-1] in ".!?" else "T")
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying edits, rows deep, and judging the roles they give."""
    found = faults_of(rows)
    best = [3 * len(rows), "D" * len(rows), []]

    def go(at, inserted, cost, audit, out):
        if cost > best[0]:
            return
        if at == len(rows):
            if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in out)) and (cost, audit) < (best[0], best[1]):
                best[:] = [cost, audit, out]
        else:
            role, text = rows[at]
            go(at + 1, 0, cost + 3, audit + "D", out)
            if found[at] in "KT":
                extra = found[at] == "T"
                go(at + 1, 0, cost + extra, audit + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    go(at + 1, 0, cost + 2 + extra, audit + "R", [*out, (new, text)])
        if inserted < 2:
            for new in ("user", "assistant"):
                go(at, inserted + 1, cost + 2, audit + "I", [*out, (new, "")])

    go(0, 0, 0, "", [])
    return best


def by_suffix(rows):
    """(cost, audit, repaired) from the end: for long conversations, where trying is too slow."""
    found = faults_of(rows)
    step = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("3", "u"): "2", ("2", "a"): "3"}
    names = {"u": "user", "a": "assistant"}
    after = {q: (0, "", []) if q in "03" else None for q in "0123"}

    def with_inserts(table):
        for _ in range(3):
            for (q, x), to in step.items():
                if x != "s" and table[to]:
                    cost, audit, out = table[to]
                    new = (cost + 2, "I" + audit, [(names[x], ""), *out])
                    if table[q] is None or new[:2] < table[q][:2]:
                        table[q] = new
        return table

    after = with_inserts(after)
    for (role, text), fault in zip(reversed(rows), reversed(found)):
        here = {}
        for q in "0123":
            cost, audit, out = after[q]
            ways = [(cost + 3, "D" + audit, out)]
            if fault in "KT":
                extra = fault == "T"
                if (q, role[:1]) in step:
                    cost, audit, out = after[step[q, role[:1]]]
                    ways.append((cost + extra, "K" + audit, [(role, text), *out]))
                for x in "ua":
                    if (q, x) in step:
                        cost, audit, out = after[step[q, x]]
                        ways.append((cost + 2 + extra, "R" + audit, [(names[x], text), *out]))
            here[q] = min(ways, key=lambda w: w[:2])
        after = with_inserts(here)
    return list(after["0"])


def counts_of(turns, rows):
    real = [t for t in turns if t is not None]
    found, initials = faults_of(rows), [r[:1] for r, _ in rows]
    return (
        max(real) - min(real) + 1 - len(set(real)) if real else 0,
        found.count("B"),
        found.count("D"),
        found.count("T"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
    )


def brute(table, solve=by_suffix):
    """Results by conversation of rows (conv_id, turn, role, text)."""
    convs: dict = {}
    for conv, turn, role, text in table:
        row = (turn is not None, turn or 0, " " if role is None else role, " " if text is None else text, turn)
        convs.setdefault(conv, []).append(row)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: r[:4])
        rows = [(r[2], r[3]) for r in own]
        cost, audit, left = solve(rows)
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv] = (*counts_of([r[4] for r in own], rows), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def damage(table):
    spelt = lambda x: " " if x is None else x
    out = []
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{spelt(conv)}:{spelt(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else spelt(role)), spelt(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def found_by(frame):
    rows = frame.collect()
    out = {r.conv_id: (*(r[c] for c in COUNTS), r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def draw_turns(draw, n, roles=("user", "assistant", "system", "tool", "")):
    texts = ["Yes.", "No", "", " \n", "Why?", "a b!  ", "end...", "so\t"]
    return [(draw.choices(roles, (8, 8, 2, 1, 1))[0], draw.choice(texts) + str(draw.randint(0, 3)) * draw.randint(0, 1)) for _ in range(n)]


def test_walk_finds_the_cheapest_and_least_edits():
    draw = random.Random(6)
    end = repair.grown(list(repair.ACCEPTED))
    for k in range(220):
        rows = draw_turns(draw, k % 5)
        roles, texts = [r for r, _ in rows], [t for _, t in rows]
        turns = repair.coded(roles, repair.faults(roles, texts, set()))
        audit, _ = repair.walk(turns, end, 0, True)
        left = list(repair.repaired_turns(audit, turns, roles, texts))
        assert [repair.before_all(turns, end)[0], audit, left] == cheapest(rows) == by_suffix(rows)


def test_long_walks_keep_few_vectors_and_agree():
    draw = random.Random(9)
    end = repair.grown(list(repair.ACCEPTED))
    for n in (17, 100, 333):
        rows = [(r, f"{t}{k}" if t.strip() else t) for k, (r, t) in enumerate(draw_turns(draw, n))]
        roles, texts = [r for r, _ in rows], [t for _, t in rows]
        turns = repair.coded(roles, repair.faults(roles, texts, set()))
        audit, _ = repair.walk(turns, end, 0, True)
        left = list(repair.repaired_turns(audit, turns, roles, texts))
        assert [repair.before_all(turns, end)[0], audit, left] == by_suffix(rows)


def odd_table():
    draw = random.Random(12)
    table = [(c, t, *x) for c in range(60) for t, x in enumerate(draw_turns(draw, draw.randint(1, 7)))]
    table += [(77, t // 3 * 2, *x) for t, x in enumerate(draw_turns(draw, 400))]  # long, ties and gaps
    table += [(None, None, "user", "a."), (None, 1, None, None), (None, 4, "assistant", "b.")]
    table += [(80, None, None, None), (80, None, "user", "x"), (81, -(2**40), "user", "y" * 40_000), (81, 2**40, "a", "z.")]
    return table


@pytest.mark.parametrize("limit", [4_096, 7])
def test_repair_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(repair, "SEGMENT_TURNS", limit)
    table = odd_table()
    schema = "conv_id long, turn long, role string, text string, audit string, at int"
    frame = spark.createDataFrame([(*r, "q", 1) for r in table], schema).repartition(6)
    assert found_by(repair.repair_conversations(frame)) == brute(table)
    wanted = dict.fromkeys({r[0] for r in table}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    assert found_by(repair.repair_damaged(frame)) == wanted | brute(damage(table))
    assert repair.repair_damaged(frame.where("false")).count() == 0


def test_query_over_the_given_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    found = found_by(QUERIES["op13_conversation_repair"](spark, sf_dir))
    assert set(found) == {r[0] for r in table}
    short = brute(damage(table))
    assert {c: found[c] for c in short} == short
    assert all(v[-1] == hashlib.sha256(b"").hexdigest() and v[6] == "" for c, v in found.items() if c not in short)
