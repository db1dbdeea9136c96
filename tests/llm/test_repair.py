"""Repair of conversations against dynamic programming over (cost, edits), and the whole query against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from vendorscope.llm import repair as R

LEGAL = re.compile(r"(s?(ua)+)?")


def plain_edits(letters, kinds):
    """Cheapest (cost, edits) by relaxing all states until nothing changes, from the back."""
    n, after = len(kinds), {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {}
    for i in range(n, -1, -1):
        if i == n:
            best[n, 0], best[n, 3] = (0, ""), (0, "")
        for _ in range(4):
            for q in range(4):
                options = [best[i, q]] if (i, q) in best else []
                for c, to in after[q].items():
                    if c != "s" and (i, to) in best:
                        options.append((best[i, to][0] + 3, "I" + best[i, to][1]))
                if i < n:
                    more = 3 * (kinds[i] == "t")
                    options.append((best[i + 1, q][0] + 4, "D" + best[i + 1, q][1]))
                    for c, to in after[q].items():
                        if kinds[i] != "x" and c == letters[i]:
                            options.append((best[i + 1, to][0] + more, "K" + best[i + 1, to][1]))
                        if kinds[i] != "x" and c != "s":
                            options.append((best[i + 1, to][0] + 3 + more, "R" + best[i + 1, to][1]))
                options = [(c, e) for c, e in options if len(e) <= 4 * n + 8]
                if options:
                    best[i, q] = min(options)
    return best[0, 0]


def test_cheapest_edits_of_random_conversations():
    rng = random.Random(1)
    for k in range(3000):
        n = rng.randrange(0, 10)
        letters = "".join(rng.choice("suau aX"[:rng.choice([4, 7])]) for _ in range(n))
        kinds = "".join(rng.choice("kkkktx"[:rng.choice([4, 5, 6])]) for _ in range(n))
        assert R.cheapest_edits(letters, kinds) == plain_edits(letters, kinds), (letters, kinds)


@pytest.mark.parametrize("letters, kinds", [("ua" * 2000, "k" * 4000), ("u" * 600, "k" * 600), ("usau" * 150, "kktk" * 150),
                                            ("ua" * 400, "kkkt" * 200), ("aus" * 200, "xkt" * 200)])
def test_long_conversations(letters, kinds):
    cost, edits = R.cheapest_edits(letters, kinds)
    assert (cost, edits) == plain_edits(letters, kinds)


def plain_query(rows):
    by = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        c = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if c == 4 else role, "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(c, 1)
    out = []
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        kinds, seen, count = "", set(), {"b": 0, "d": 0, "t": 0}
        for _, role, text in mine:
            s = text.strip(" \t\n\v\f\r")
            fault = "b" if not s else "d" if (role, text) in seen else "t" if s[-1] not in ".!?" else ""
            seen.add((role, text))
            kinds += {"b": "x", "d": "x", "t": "t", "": "k"}[fault]
            if fault:
                count[fault] += 1
        letters = "".join(r[:1] or " " for _, r, _ in mine)
        illegal = sum(letters[i:i + 2] not in ("su", "ua", "au") for i in range(len(letters) - 1))
        cost, audit = plain_edits(letters, kinds)
        lines, k, last = [], 0, ""
        for e in audit:
            forced = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append(forced + ":")
            else:
                _, role, text = mine[k]
                k += 1
                if e != "D":
                    lines.append((forced if e == "R" else role) + ":" + text)
            if e != "D":
                last = lines[-1][0]
        assert LEGAL.fullmatch("".join(x[0] for x in lines))
        out.append((conv, gaps, count["b"], count["d"], count["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn int, role string, text string, audit string, edit int"


def run(spark, tmp_path, rows, schema=SCHEMA):
    from vendorscope.llm.queries import QUERIES
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    return sorted((tuple(r) for r in QUERIES["op12_repair"](spark, str(tmp_path)).collect()), key=str)


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    texts = ["Yes.", "No!", "Well", "", None, " \t\n", "Why? ", "x" * 50000 + ".", "a.\n", "Sí.", "b:c\nd."]
    roles = ["user", "assistant", "system", None, "", "User", "usher", "tool"]
    rows = [(c, t, "user" if t % 2 else "assistant" if t else "system", f"t{c} {t}.") for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(100 + c, rng.choice([None, 1, 2, 3, 9]), rng.choice(roles), rng.choice(texts)) for c in range(60) for _ in range(rng.randrange(1, 7))]
    rows += [(None, t, "user", "null id.") for t in range(5)] + [(7, 1, "user", "repeated row.")] * 3
    rows += [(500, t, rng.choice(roles[:3]), rng.choice(texts[:3]) + str(rng.randrange(90))) for t in range(700)]
    assert run(spark, tmp_path, [(*r, "clash", 1) for r in rows]) == plain_query(rows)


def test_query_on_given_rows(spark):
    from tests.conftest import SF_SMALL
    from vendorscope.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op12_repair"](spark, SF_SMALL).collect()), key=str) == plain_query(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "tool", "Cut"), (2, 0, "user", "")]
    got = sorted(tuple(r) for r in R.repaired(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect())
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in got] == [
        (1, 1, "K", "user", "Hi."), (1, 2, "I", "assistant", ""), (1, 3, "K", "user", "Hello."), (1, 4, "R", "assistant", "Cut")] or \
        R.cheapest_edits("uut", "kkt")[1] != "KIKR"


def test_nothing(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
    empty = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert R.summaries(empty).collect() == [] and R.repaired(empty).collect() == [] and R.digests(empty).collect() == []
