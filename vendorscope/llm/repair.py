"""Repair of conversation structure by iterative-deepening A*.

A conversation's rows, in order of turn, are edited at least cost until the first letters of their roles read ``(s?(ua)+)?``. The
search goes depth first, edits in ASCII order of their letters, under a cost bound that grows to the least estimate beyond it;
a table of failed states keeps, for each (row, state of the grammar), the cost that was proven not to suffice. The first
accepted path under the first bound that has one is the cheapest, and among these the least in ASCII order.

Two passes over sorted rows, both streams. The first reads two letters and a digest per row and finds the edits; the second gets
a conversation's edits before its rows and rewrites the texts as they pass. So a task holds a few bytes per row of one conversation, never
its texts. That one task reads a whole conversation in order cannot be avoided where one hash covers its repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorscope.llm.common import saved

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# States of the grammar: nothing yet, after s, after u, after a; the next letter that an edit may write in each.
START, SYSTEM, USER, ASSISTANT = range(4)
WRITES = "uuau"
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MISSING = (0, 2 * INSERT, INSERT, 0)  # what a state lacks at the end
ROLE = {"u": "user", "a": "assistant"}
FINE, BAD, CUT = "kxt"                # a row that may stay, one that must go, a truncated one


def _estimates(letters: str, kinds: str) -> tuple[list[int], list[int], list[int]]:
    """Per row from the back: costs that nothing avoids, the next row that may stay, and costs of disjoint illegal pairs of such rows."""
    n = len(kinds)
    sure, following, pairs = [0] * (n + 1), [n] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        sure[i] = sure[i + 1] + (DELETE if kinds[i] == BAD else TRUNCATED if kinds[i] == CUT else 0)
        following[i] = following[i + 1] if kinds[i] == BAD else i
        j = following[i + 1]
        if kinds[i] == BAD:
            pairs[i] = pairs[i + 1]
            continue
        legal = letters[i] + letters[j] in ("su", "ua", "au") if j < n else letters[i] == "a"
        cut = kinds[i] == CUT or (j < n and kinds[j] == CUT)
        cost = 0 if legal else DELETE - TRUNCATED if cut else INSERT
        pairs[i] = max(pairs[j], cost + (pairs[following[j + 1]] if j < n else 0))
    return sure, following, pairs


def cheapest_edits(letters: str, kinds: str) -> tuple[int, str]:
    """Cost and letters (D, I, K, R) of the cheapest edits, the least in ASCII order among equals.

    ``letters``: first letter of each row's role; ``kinds``: k (may stay), t (truncated), x (must be deleted).
    """
    n = len(kinds)
    sure, following, pairs = _estimates(letters, kinds)

    def estimate(node: int) -> int:
        i, state = divmod(node, 4)
        j = following[i]
        if j == n:
            return sure[i] + MISSING[state]
        first = 0 if (state, letters[j]) in AFTER else DELETE - TRUNCATED if kinds[j] == CUT else INSERT
        return sure[i] + max(pairs[j], first + pairs[following[j + 1]])

    def edits(node: int) -> list[tuple[str, int, int]]:
        i, state = divmod(node, 4)
        written = AFTER[state, WRITES[state]]
        if i == n:
            return [("I", INSERT, node - state + written)]
        down = 4 * (i + 1)
        out = [("D", DELETE, down + state), ("I", INSERT, node - state + written)]
        if kinds[i] != BAD:
            more = TRUNCATED if kinds[i] == CUT else 0
            kept = AFTER.get((state, letters[i]))
            if kept is not None:
                out.append(("K", more, down + kept))
            out.append(("R", REROLE + more, down + written))
        return out

    needs: dict[int, int] = {}  # failed states: a cost below this does not suffice from here
    bound = estimate(0)
    while True:
        # Frames: node, what may still be spent, edits left to try, the least cost seen beyond that.
        frames, path = [[0, bound, iter(edits(0)), None]], []
        while frames:
            node, budget, left, _ = frames[-1]
            if node >= 4 * n and MISSING[node & 3] == 0:
                return bound - budget, "".join(path)
            for letter, cost, child in left:
                need = needs.get(child)
                if need is None:
                    need = needs[child] = estimate(child)
                if cost + need <= budget:
                    frames.append([child, budget - cost, iter(edits(child)), None])
                    path.append(letter)
                    break
                if frames[-1][3] is None or cost + need < frames[-1][3]:
                    frames[-1][3] = cost + need
            else:  # nothing within the budget: remember what would have been needed
                failed = frames.pop()
                needs[node] = failed[3]
                if frames:
                    path.pop()
                    cost = frames[-1][1] - budget
                    if frames[-1][3] is None or cost + failed[3] < frames[-1][3]:
                        frames[-1][3] = cost + failed[3]
        bound = needs[0]


BLANK = r"\A[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def _cleaned(conversations: DataFrame) -> DataFrame:
    """The four columns that count, null roles and texts as one space, with the text's digest that settles order and equality."""
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                                F.unhex(F.md5(text.cast("binary"))).alias("digest"))


ORDER = ("turn", "role", "digest")


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of rows that arrive in order: faults, gaps, cost and edits."""
    conv: object = None
    open_ = False

    def done():
        cost, audit = cheapest_edits("".join(letters), "".join(kinds))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        return {"conv_id": conv, "gaps": gaps, "blank": faults[0], "duplicate": faults[1], "truncated": faults[2],
                "illegal": illegal, "cost": cost, "audit": audit}

    def schema(batch):
        long = pa.int64()
        return pa.schema([("conv_id", batch.schema.field("conv_id").type), *((c, long) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])

    form, out = None, []
    for batch in batches:
        form = form or schema(batch)
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "is_blank", "is_cut")]
        for c, turn, role, digest, blank, cut in zip(*cols):
            if not open_ or c != conv:
                if open_:
                    out.append(done())
                conv, open_ = c, True
                letters, kinds, seen, faults, illegal, turns = [], [], set(), [0, 0, 0], 0, [None, None, 0]
            if turn is not None and turn != turns[1]:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            letter, key = role[:1] or " ", (role, digest)
            illegal += bool(letters) and letters[-1] + letter not in ("su", "ua", "au")
            fault = 0 if blank else 1 if key in seen else 2 if cut else None
            seen.add(key)
            letters.append(letter)
            kinds.append(FINE if fault is None else (BAD, BAD, CUT)[fault])
            if fault is not None:
                faults[fault] += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=form)
            out = []
    if open_:
        yield pa.RecordBatch.from_pylist([done()], schema=form)


def summaries(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit.

    Rows (conv_id, turn, role, text; others are ignored) count in order of turn, nulls first; equal turns in order of role and then of the
    text's MD5. Null conversation ids are one conversation; null roles and texts are one space. Faults: blank, else duplicate (role
    and text stood in an earlier row), else truncated. ``audit`` has one letter per edit. An empty table gives an empty one.
    """
    text = F.col("text")
    narrow = _cleaned(conversations).select("conv_id", "turn", "role", "digest", text.rlike(BLANK).alias("is_blank"),
                                            (~text.rlike(ENDED)).alias("is_cut"))
    kind = conversations.schema["conv_id"].dataType
    out = T.StructType([T.StructField("conv_id", kind), *(T.StructField(c, T.LongType()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), T.StructField("audit", T.StringType())])
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(_summary, out)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row of the conversation's summary, edit, role, text) of every repaired row; a conversation's summary arrives before its rows.

    A conversation starts with (summary, None, None, None).
    """
    head, at, state = None, 0, START

    def inserted():
        nonlocal at, state
        while at < len(head["audit"]) and head["audit"][at] == "I":
            letter = WRITES[state]
            state, at = AFTER[state, letter], at + 1
            yield head, "I", ROLE[letter], ""

    for batch in batches:
        for row in batch.to_pylist():
            if not row["is_row"]:
                if head:
                    yield from inserted()
                head, at, state = row, 0, START
                yield head, None, None, None
                continue
            yield from inserted()
            edit = head["audit"][at]
            at += 1
            if edit == "D":
                continue
            letter = WRITES[state] if edit == "R" else row["role"][:1]
            state = AFTER[state, letter]
            yield head, edit, ROLE[letter] if edit == "R" else row["role"], row["text"]
    if head:
        yield from inserted()


def _joined(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Summaries and rows in one sorted stream per conversation."""
    rows = _cleaned(conversations).withColumn("is_row", F.lit(True))
    both = rows.unionByName(found.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *ORDER)


def repaired(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), edit (K, R or I), role, text.

    ``found``: the written result of ``summaries``, if it is there already. Handling as there; deleted rows are absent, so a conversation
    may have no rows.
    """
    found = saved(summaries(conversations), "edits") if found is None else found
    kind = conversations.schema["conv_id"].dataType
    out = T.StructType([T.StructField("conv_id", kind), T.StructField("place", T.LongType()), *(
        T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, rows, place = None, [], 0

        def typed(stream):
            nonlocal form
            for b in stream:
                form = form or pa.schema([("conv_id", b.schema.field("conv_id").type), ("place", pa.int64()),
                                          *((c, pa.string()) for c in ("edit", "role", "text"))])
                yield b

        for head, edit, role, text in _edited(typed(batches)):
            place = 0 if edit is None else place + 1
            if edit is not None:
                rows.append({"conv_id": head["conv_id"], "place": place, "edit": edit, "role": role, "text": text})
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_pylist(rows, schema=form)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=form)

    return _joined(conversations, found).mapInArrow(run, out)


def digests(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``summaries`` with ``repaired_sha256``: SHA-256 of the repaired rows as ``role:text``, one per line, hashed as they pass."""
    found = saved(summaries(conversations), "edits") if found is None else found
    out = T.StructType([*found.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    names = found.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, rows, digest, first, last = None, [], None, True, None

        def typed(stream):
            nonlocal form
            for b in stream:
                form = form or pa.schema([*(b.schema.field(c) for c in names), ("repaired_sha256", pa.string())])
                yield b

        def done():
            return {**{c: last[c] for c in names}, "repaired_sha256": digest.hexdigest()}

        for head, edit, role, text in _edited(typed(batches)):
            if edit is None:
                if last is not None:
                    rows.append(done())
                if len(rows) >= 1024:
                    yield pa.RecordBatch.from_pylist(rows, schema=form)
                    rows = []
                digest, first, last = hashlib.sha256(), True, head
                continue
            digest.update(("" if first else "\n").encode() + role.encode() + b":" + text.encode())
            first = False
        if last is not None:
            rows.append(done())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=form)

    return _joined(conversations, found).mapInArrow(run, out)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults dealt by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes its role ``user``; the others stay.
    Nulls count as one space, in the key as in role and text; a null conversation id or turn stays null.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    c: Column = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(c == 1, "").when(c == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(c == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.when(c == 0, 0).when(c == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop("col")
