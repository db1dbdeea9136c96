"""Spelling variants: words one edit apart, found with blocked Gram matrices of letter counts.

One inserted or deleted letter changes a word's vector of letter counts by a squared distance of 1, one replaced letter by 2. The
words of one length and of equal counts in a few classes of letters make a cell; near words lie in the same cell or in one
that differs by one letter in one class (a length further) or in two (same length). Cells are cut into blocks, blocks meet in a join, and a
NumPy product of two blocks' count matrices gives all squared distances; pairs at most two apart are compared letter by letter.

The classes are dealt from the letters' frequencies in all words, so cells stay small; what grows with the vocabulary is the number of
blocks, never a block. Words are counted over all whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import dropped, rows, saved

CLASSES = 6            # classes of letters; a cell is a length and the counts of each class
BLOCK_WORDS = 1024     # words of a block
BLOCK_LETTERS = 1 << 21  # and their letters together, unless a single word is longer
COMPARED = 1 << 23     # letters compared at once
PIECE = 1 << 22        # bytes of a text whose words are counted at once
KEPT_WORDS = 200_000   # distinct words counted before they are passed on
# UTF-8: U+00C0 to U+00FF are C3 80 to C3 BF; all other characters of several bytes separate words, as do other ASCII ones.
OTHERS = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")
ASCII = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
COLUMN = np.zeros(256, np.int64)
COLUMN[LETTERS] = range(len(LETTERS))


def _pieces(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lower case, piece by piece; a piece ends where a word does."""
    at = 0
    while at < len(text):
        end = at + piece
        while end < len(text) and text[end] >= 65:  # no separator below U+0041: go on to one, so nothing is cut
            end += 1
        yield OTHERS.sub(b" ", text[at:end]).translate(ASCII).split()
        at = end


def _counted(every: int, least: int):
    """Function of Arrow batches (key, text) that counts their words of ``least`` characters or more; one run in ``every`` loses a letter."""
    form = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flushed():
            words = [(w.decode(), n) for w, n in total.items() if n and len(w) >= least]
            words = [x for x in words if len(x[0]) >= least]
            total.clear()
            return pa.RecordBatch.from_pydict({"word": [w for w, _ in words], "n": [n for _, n in words]}, schema=form)

        for batch in rows(batches, 64):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                for words in _pieces(text or b""):
                    total.update(words)
                    for w in set(words):
                        h = zlib.crc32(w, start)
                        if h % every == 0:
                            n, run_ = words.count(w), w.decode()
                            at = h % len(run_)
                            total[w] -= n
                            total[(run_[:at] + run_[at + 1:]).encode()] += n
                    if len(total) >= KEPT_WORDS:
                        yield flushed()
        yield flushed()

    return run


def vocabulary(docs: DataFrame, least_length: int = 6, least_n: int = 5, every: int = 199, key: str = "doc_id") -> DataFrame:
    """Rows (word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, at least ``least_n`` times in all texts.

    A run whose crc32 with its document's id (``<id>:<run>``) is divisible by ``every`` loses the character at that number modulo its
    length. Null texts have no words; the id of a row without one is the empty string; repeated rows count each time. Counts of a
    batch are combined before they are shuffled, so a word that stands everywhere is one row per batch.
    """
    d = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col("text"))
    found = d.mapInArrow(_counted(every, least_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _letter_totals(words: DataFrame) -> np.ndarray:
    """How often each letter stands in the words: one vector per task, summed."""
    def run(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            for w in b.column("word").to_pylist():
                total += np.bincount(np.frombuffer(w.encode("latin-1"), np.uint8), minlength=256)
        yield pa.RecordBatch.from_pydict({"code": list(range(256)), "n": total.tolist()},
                                         schema=pa.schema([("code", pa.int32()), ("n", pa.int64())]))

    out = np.zeros(256, np.int64)
    for r in words.select("word").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def letter_classes(totals: np.ndarray, classes: int) -> np.ndarray:
    """Class of every character code: letters in order of frequency, each to the class that has least so far."""
    held, out = [0] * classes, np.zeros(256, np.int64)
    for code in sorted(range(256), key=lambda c: (-totals[c], c)):
        to = min(range(classes), key=lambda k: (held[k], k))
        out[code] = to
        held[to] += int(totals[code]) + 1
    return out


def _celled(classes: np.ndarray, n: int):
    """Function of Arrow batches (word, n) that adds a word's cell: how often each of ``n`` classes of letters stands in it."""
    def run(batches):
        for b in batches:
            words = b.column("word").to_pylist()
            cells = [",".join(map(str, np.bincount(classes[np.frombuffer(w.encode("latin-1"), np.uint8)], minlength=n)))
                     for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), b.column("word"), b.column("n")], ["cell", "word", "n"])
    return run


def _blocked(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``most`` sorted words: cell, number of the block in its cell, words, counts."""
    cell, number, words, ns, letters, out = None, 0, [], [], 0, []
    form = pa.schema([("cell", pa.string()), ("number", pa.int32()), ("words", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])

    def block():
        return {"cell": cell, "number": number, "words": words, "ns": ns}

    for b in batches:
        for c, w, n in zip(b.column("cell").to_pylist(), b.column("word").to_pylist(), b.column("n").to_pylist()):
            if words and (c != cell or len(words) >= most or letters + len(w) > BLOCK_LETTERS):
                out.append(block())
                number, words, ns, letters = number + 1 if c == cell else 0, [], [], 0
            cell, letters = c, letters + len(w)
            words.append(w)
            ns.append(n)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=form)
            out = []
    if words:
        yield pa.RecordBatch.from_pylist([block()], schema=form)


def _targets(cell, classes: int):
    """Cells in which a cell's words have near words, each unordered pair of cells once: itself, one letter moved from a later class to
    an earlier one, one letter more in any class."""
    counts = F.split(cell, ",").cast("array<int>")

    def moved(up: int, down: int | None):
        return F.array_join(F.transform(counts, lambda c, i: c + F.when(i == up, 1).when(
            i == (-1 if down is None else down), -1).otherwise(0)), ",")

    same = [F.when(F.element_at(counts, j + 1) > 0, moved(i, j)) for i in range(classes) for j in range(i + 1, classes)]
    return F.array_compact(F.array(cell, *same, *[moved(i, None) for i in range(classes)]))


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _counts(letters: np.ndarray) -> np.ndarray:
    out = np.zeros((len(letters), len(LETTERS)), np.float32)
    at = np.arange(len(letters))
    for column in COLUMN[letters].T:
        out[at, column] += 1
    return out


def near_pairs(a: np.ndarray, b: np.ndarray, one_block: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of words one edit apart in two blocks of letters; the second block's words are as long or one letter longer.

    Squared distances come from one product of the count matrices (exact: small whole numbers); pairs at most 2 apart are compared.
    Of one block with itself each pair comes once.
    """
    x, y = _counts(a), _counts(b)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(distance <= 2)
    if one_block:
        i, j = i[i < j], j[i < j]
    width, found = a.shape[1], []
    step = max(1, COMPARED // max(1, width))
    for k in range(0, len(i), step):
        p, q = a[i[k:k + step]], b[j[k:k + step]]
        if b.shape[1] == width:
            found.append((p != q).sum(1) == 1)
        else:  # as many equal letters from the front and from the back as the shorter word has
            front = np.logical_and.accumulate(p == q[:, :-1], axis=1).sum(1)
            back = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(1)
            found.append(front + back >= width)
    near = np.concatenate(found) if found else np.zeros(0, bool)
    return i[near], j[near]


def _best(word: list[str], ns: list[int], i: np.ndarray, other: list[str], other_ns: list[int], j: np.ndarray) -> list[tuple]:
    """Per word with near words among ``other``: how many, and the count and text of the one of largest count (words are sorted)."""
    n = np.asarray(other_ns, np.int64)
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    first, times = np.unique(i, return_index=True, return_counts=True)[1:]
    return [(word[i[k]], int(t), int(n[j[k]]), other[j[k]]) for k, t in zip(first, times)]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    form = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    for b in rows(batches, 16):
        out = []
        for r in b.to_pylist():
            words, others = r["words"], r["others"]
            i, j = near_pairs(_letters(words), _letters(others), r["one_block"])
            out += _best(words, r["ns"], i, others, r["other_ns"], j)
            out += _best(others, r["other_ns"], j, words, r["ns"], i)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), form.types)], schema=form)


def near_words(words: DataFrame, classes: int = CLASSES, block: int = BLOCK_WORDS) -> DataFrame:
    """Rows (word, n_near, best_n, best) for every word of ``words`` (word, n; distinct) that has words one edit away.

    ``best`` is the near word of largest ``best_n``, the smallest in code-point order among equals. Words of any length are compared; words hold
    only letters up to U+00FF. An empty table gives an empty one.
    """
    dealt = letter_classes(_letter_totals(words), classes)
    cells = words.select("word", "n").mapInArrow(_celled(dealt, classes), "cell string, word string, n long")
    blocks = saved(cells.repartition("cell").sortWithinPartitions("cell", "word")
                   .mapInArrow(lambda b: _blocked(b, block), "cell string, number int, words array<string>, ns array<long>"), "blocks")
    home = blocks.select(F.col("cell").alias("home"), F.col("number").alias("home_number"), "words", "ns", 
                         F.explode(_targets(F.col("cell"), classes)).alias("cell"))
    guest = blocks.select("cell", "number", F.col("words").alias("others"), F.col("ns").alias("other_ns"))
    itself = F.col("home") == F.col("cell")
    pairs = home.join(guest, "cell").where(~itself | (F.col("home_number") <= F.col("number")))
    pairs = pairs.select("words", "ns", "others", "other_ns", (itself & (F.col("home_number") == F.col("number"))).alias("one_block"))
    found = pairs.mapInArrow(_compared, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame, most: int, times: int, least: int) -> DataFrame:
    """Rows (word, root) for rows (word, form): forms followed to the last.

    A form is at least ``times`` as frequent as its word, so a chain from ``least`` to ``most`` occurrences has a bounded length; each round
    doubles the steps taken.
    """
    steps = max(1, math.floor(math.log(max(most, 1) / least, times)) + 1 if most >= least else 1)
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(steps)) + 1 if steps > 1 else 0):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = saved(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        dropped(now)
        now = after
    return now


def variants(docs: DataFrame, least_length: int = 6, least_n: int = 5, every: int = 199, times: int = 5, key: str = "doc_id") -> DataFrame:
    """Every word of the ``vocabulary`` of ``docs`` with its spelling group: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one inserted, deleted or replaced character) of largest count, if that is at least ``times`` the word's own, else
    null, as is its count ``form_n``; ``root`` is where forms lead to, the word itself without one. Ties go to the smallest in code-point
    order. Extra columns are ignored; an empty table, or texts without such words, give an empty one.
    """
    words = saved(vocabulary(docs, least_length, least_n, every, key), "words")
    near = near_words(words)
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    formed = saved(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"),
                                                          F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    last = roots(formed.where("form is not null"), most, times, least_n)
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
