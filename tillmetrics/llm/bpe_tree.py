"""BPE encoding by tree concatenation, and decoding, with a tokenizers vocabulary file.

Texts of up to `leaf` code points are encoded where they are read. A longer one is halved until
every piece is a leaf; Spark deals the leaves out and encodes them in parallel. A document's
leaves then meet in one task and are joined pairwise, level by level: a window around the join is
encoded anew and doubled until it agrees with what stands on either side. It agrees

* at a token that begins after white space, which no token or rule of the vocabulary reaches across;
* inside an unbroken run of letters, where AGREE tokens in a row are equal on both sides: a BPE
  encoding is right if each two neighbours are, and these have all been neighbours in a right one;
* at the very beginning or end of the text.

The result is that of encoding the whole text at once. A long text is in one task as a row of the
table anyway; nothing else is gathered. Words a worker remembers are bounded by their bytes, and those
of texts without white space are not remembered, so that memory doesn't grow with such texts. The
vocabulary file is read once by the driver and
broadcast: its size doesn't depend on the data.

Null texts are empty; empty texts have no tokens; repeated rows give repeated results, rows
without doc_id included; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillmetrics.llm.text import table, whole

LEAF = 32_768  # code points
WINDOW = 64  # code points on either side of a join, to begin with
AGREE = 4  # equal tokens in a row inside a run of letters
BATCH = 1 << 18  # code points encoded at a time
CACHE = 48 << 20  # bytes (by cost()) of the words a worker remembers, old and new ones
ENTRY = 100  # bytes of a remembered word beside its text and ids: a bytes object, a place in a growing dict
LONG = 128  # longer words, as texts without white space have them, are not remembered
EDGE = 1024  # code points at either end of a leaf whose tokens are kept one by one
SPACE = frozenset(" \t\n\r")


def load(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(vocabulary)
    made.no_truncation()
    made.no_padding()
    return made


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of a text that is halved until none is longer than `leaf`, left to right."""
    count = 1
    while len(text) > leaf * count:
        count *= 2
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


Tokens = list[tuple[int, int, int]]  # id, first and last code point (exclusive)
Part = tuple[int, str, str]  # number of ids, the ids in decimal, the tokens


def tokens_of(tokenizer, text: str, at: int = 0) -> Tokens:
    made = tokenizer.encode(text, add_special_tokens=False)
    return [(i, a + at, b + at) for i, (a, b) in zip(made.ids, made.offsets)]


def _letter(text: str, at: int) -> bool:
    # Letters from the Hangul jamo on may still combine with each other.
    return 0 <= at < len(text) and text[at].isalpha() and text[at] < "ᄀ"


def _in_letters(text: str, first: int, last: int) -> bool:
    return all(_letter(text, i) for i in range(first - 1, last + 1))


def _agree_left(text: str, left: Tokens, window: Tokens, join: int) -> tuple[int, int] | None:
    """How many tokens of the left side stay, and from which of the window's tokens to go on."""
    starts = {}
    for k, t in enumerate(window):
        starts.setdefault(t[1], k)
    for i in range(len(left) - 1, -1, -1):
        x = left[i][1]
        if x < window[0][1] or x >= join or (i and left[i - 1][1] == x):
            continue
        k = starts.get(x)
        if k is None:
            continue
        if x and text[x - 1] in SPACE:
            return i, k
        if (
            min(i, k) >= AGREE
            and left[i - AGREE : i] == window[k - AGREE : k]
            and _in_letters(text, left[i - AGREE][1], x)
        ):
            return i, k
    return None


def _agree_right(text: str, right: Tokens, window: Tokens, join: int) -> tuple[int, int] | None:
    """From which token of the right side to go on, and how many of the window's tokens stay."""
    starts = {}
    for k, t in enumerate(window):
        starts.setdefault(t[1], k)
    for j, (_, x, _) in enumerate(right):
        if x > window[-1][1]:
            return None
        if x <= join or (j and right[j - 1][1] == x):
            continue
        k = starts.get(x)
        if k is None:
            continue
        if text[x - 1] in SPACE:
            return j, k
        if (
            right[j : j + AGREE] == window[k : k + AGREE]
            and len(window) >= k + AGREE + 1
            and len(right) >= j + AGREE
            and _in_letters(text, x, right[j + AGREE - 1][2])
        ):
            return j, k
    return None


def join_up(tokenizer, text: str, left: Node, right: Node) -> Tokens | None:
    """Tokens from left.last to right.head with the join mended; None if it takes more than those."""
    own, rest, join, reach = left.last, right.head, left.hi, WINDOW
    from_start, to_end = not left.parts, not right.parts
    lowest = left.lo if from_start else own[0][1] if own else join
    highest = right.hi if to_end else rest[-1][2] if rest else join
    while True:
        first, last = max(lowest, join - reach), min(highest, join + reach)
        window = tokens_of(tokenizer, text[first:last], first)
        at_start, at_end = from_start and first == lowest, to_end and last == highest
        kept = (0, 0) if at_start else _agree_left(text, own, window, join) if window else None
        then = (
            (len(rest), len(window))
            if at_end
            else _agree_right(text, rest, window, join) if window else None
        )
        if kept and then and kept[1] <= then[1]:
            return own[: kept[0]] + window[kept[1] : then[1]] + rest[then[0] :]
        if first == lowest and last == highest:
            return None
        reach *= 2


class Node(NamedTuple):
    """A stretch of the text: tokens at both ends, and what lies between them as finished parts.

    Without parts, `head` holds all of its tokens and `tail` none.
    """

    lo: int
    hi: int
    head: Tokens
    parts: list[Part]
    tail: Tokens

    @property
    def last(self) -> Tokens:
        return self.tail if self.parts else self.head


def solid(tokenizer, text: str, lo: int, hi: int) -> Node:
    return Node(lo, hi, tokens_of(tokenizer, text[lo:hi], lo), [], [])


def node_of_leaf(words: Words, piece: str, edge: int) -> Node:
    """Only the ends of a leaf need their tokens one by one; white space separates the middle."""
    ends = [(piece.find(c, edge), piece.rfind(c, 0, max(0, len(piece) - edge))) for c in " \n"]
    first = min((a for a, _ in ends if a >= 0), default=-1) + 1
    last = max(b for _, b in ends) + 1
    if not 0 < first < last:
        return solid(words.tokenizer, piece, 0, len(piece))
    head = tokens_of(words.tokenizer, piece[:first])
    tail = tokens_of(words.tokenizer, piece[last:], last)
    return Node(0, len(piece), head, words.encode([piece[first:last]]), tail)


def join_nodes(words: Words, text: str, left: Node, right: Node) -> Node:
    found = join_up(words.tokenizer, text, left, right)
    while found is None:  # it takes more than the ends: this stretch has hardly any white space
        left = solid(words.tokenizer, text, left.lo, left.hi)
        right = solid(words.tokenizer, text, right.lo, right.hi)
        found = join_up(words.tokenizer, text, left, right)
    lo, hi = left.lo, right.hi
    if left.parts and right.parts:
        parts = [*left.parts, words.part([i for i, _, _ in found]), *right.parts]
        return Node(lo, hi, left.head, parts, right.tail)
    if left.parts:
        return Node(lo, hi, left.head, left.parts, found)
    return Node(lo, hi, found, right.parts, right.tail)


def concatenate(words: Words, leaves: list[tuple[str, Node]]) -> Part:
    """The text whose leaves these are, put together level by level."""
    text, nodes, at = "".join(piece for piece, _ in leaves), [], 0
    for piece, own in leaves:
        head, tail = ([(i, a + at, b + at) for i, a, b in t] for t in (own.head, own.tail))
        nodes.append(Node(at, at + len(piece), head, own.parts, tail))
        at += len(piece)
    while len(nodes) > 1:
        joined = [join_nodes(words, text, a, b) for a, b in zip(nodes[::2], nodes[1::2])]
        nodes = joined + nodes[len(joined) * 2 :]
    root = nodes[0]
    ends = [words.part([i for i, _, _ in t]) for t in (root.head, root.tail)]
    return words.together([ends[0], *root.parts, ends[1]])


class Words:
    """Encodes texts as parts: (number of ids, decimal ids, decoded text), each joined by blanks.

    No normalisation or rule of the vocabulary reaches across a blank or a line break, so the ids of
    a text are those of its words in a row. Words met lately are looked up; what else counts as
    white space stays inside a word and is left to the tokenizer. Of a word only its ids are
    remembered, four bytes each: a part is made of all ids of a text at once.
    """

    def __init__(self, tokenizer, most: int = CACHE):
        self.tokenizer, self.most = tokenizer, most
        self.size = 0  # of the words in `known`
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        count = max(vocabulary.values()) + 1
        self.decimal = np.array([str(i) for i in range(count)], object)
        self.tokens = np.full(count, "", object)
        for token, i in vocabulary.items():
            self.tokens[i] = token
        if tokenizer.decoder is not None:
            raise ValueError("decoded texts are only put together from tokens without a decoder")

    def part(self, ids: list[int] | np.ndarray) -> Part:
        ids = np.asarray(ids, np.int32)
        return len(ids), " ".join(self.decimal[ids].tolist()), " ".join(self.tokens[ids].tolist())

    @staticmethod
    def together(parts: list[Part]) -> Part:
        parts = [p for p in parts if p[0]]
        return (
            sum([p[0] for p in parts]),
            " ".join([p[1] for p in parts]),
            " ".join([p[2] for p in parts]),
        )

    @staticmethod
    def cost(word: str, ids: bytes | Part) -> int:
        """About how many bytes a remembered word takes, whose ids are given packed or as a part."""
        return ENTRY + sys.getsizeof(word) + (len(ids) if isinstance(ids, bytes) else 4 * ids[0])

    def encode(self, texts: list[str]) -> list[Part]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known, before, new, size = self.known, self.before, [], self.size
        for w in set(chain.from_iterable(split)).difference(known):
            if w in before:
                known[w] = ids = before[w]
                size += self.cost(w, ids)
            else:
                new.append(w)
        made = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        packed = [array("i", m.ids).tobytes() for m in made]
        known.update(zip(new, packed))
        joined = [
            self.part(np.frombuffer(b"".join([known[w] for w in words]), np.int32)) for words in split
        ]
        self.size = size + sum(map(self.cost, new, packed))
        for w in new:
            if len(w) > LONG:
                self.size -= self.cost(w, known.pop(w))
        if self.size > self.most // 2:
            self.known, self.before, self.size = {}, known, 0
        return joined


def _words(vocabulary) -> Words:
    """A worker holds the value of a broadcast between its tasks, and so what they have met."""
    held = vocabulary.value
    if "words" not in held:
        held["words"] = Words(load(held["file"]))
    return held["words"]


def _digests(part: Part) -> tuple[int, str, str]:
    n, ids, decoded = part
    return n, *(hashlib.sha256(x.encode("utf-8")).hexdigest() for x in (ids, decoded))


def _ids(part: Part) -> np.ndarray:
    return np.array(part[1].split(), np.int32)


OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _batches(sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of about BATCH code points."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BATCH:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def _encode_short(vocabulary, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in batches:
            words = words or _words(vocabulary)
            texts = batch.column("text").to_pylist()
            kept = [c for c in batch.schema.names if c != "text"]
            for rows in _batches([len(t) for t in texts]):
                made = words.encode(texts[rows])
                n, a, b = zip(*map(_digests, made))
                part = batch.slice(rows.start, rows.stop - rows.start)
                columns = [*[part.column(c) for c in kept], pa.array(n, pa.int64()), pa.array(a), pa.array(b)]
                if with_ids:
                    columns.append(pa.array([_ids(m) for m in made], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    columns, [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
                )

    return run


def _cut(leaf: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                pieces = halves(text, leaf)
                row = batch.slice(i, 1)
                own = [
                    pa.concat_arrays([row.column(c)] * len(pieces))
                    for c in batch.schema.names
                    if c != "text"
                ]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(range(len(pieces)), pa.int32()), pa.array(pieces)],
                    [*[c for c in batch.schema.names if c != "text"], "leaf", "piece"],
                )

    return run


LEAVES = "head array<int>, n long, ids string, decoded string, tail array<int>"


def _encode_leaves(vocabulary, edge: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in batches:
            words = words or _words(vocabulary)
            for i, piece in enumerate(batch.column("piece").to_pylist()):
                node = node_of_leaf(words, piece, edge)
                n, ids, decoded = node.parts[0] if node.parts else (-1, "", "")
                head, tail = (pa.array([list(chain(*t))], pa.list_(pa.int32())) for t in (node.head, node.tail))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, head, *map(pa.array, ([n], [ids], [decoded])), tail],
                    [*batch.schema.names, *[x.split()[0] for x in LEAVES.split(", ")]],
                )

    return run


def _node(row: dict) -> Node:
    head, tail = (list(zip(*[iter(row[k])] * 3)) for k in ("head", "tail"))
    parts = [(row["n"], row["ids"], row["decoded"])] if row["n"] >= 0 else []
    return Node(0, len(row["piece"]), head, parts, tail)


def _join_leaves(vocabulary, kept: list[str], with_ids: bool, out: str) -> Callable:
    names = [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = to_arrow_schema(T._parse_datatype_string(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(b.slice(i, 1).to_pylist() for b in batches for i in range(len(b)))
        words = None
        for _, group in groupby(rows, key=lambda r: r["row_key"]):
            words = words or _words(vocabulary)
            leaves: dict[int, dict] = {}
            copies = 0  # rows repeated in the table share their leaves
            for r in group:
                copies += r["leaf"] == 0
                leaves.setdefault(r["leaf"], r)
            own = list(leaves.values())
            part = concatenate(words, [(r["piece"], _node(r)) for r in own])
            values = [*[own[0][c] for c in kept], *_digests(part)]
            row = dict(zip(names, [*values, _ids(part)] if with_ids else values))
            yield pa.RecordBatch.from_pylist([row] * copies, schema)

    return run


def encode(
    docs: DataFrame,
    path: str,
    leaf: int = LEAF,
    keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = False,
    edge: int = EDGE,
) -> DataFrame:
    """Columns `keep` of docs with n_tokens and the digests of the ids and of the decoded text."""
    file = Path(path).read_text(encoding="utf-8")
    vocabulary = docs.sparkSession.sparkContext.broadcast({"file": file})
    kinds = dict(docs.dtypes)
    own = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    out = f"{own}, {OUT}" + ", ids array<int>" * with_ids
    rows = docs.select(*keep, whole("text").alias("text"))
    short = rows.filter(F.length("text") <= leaf).mapInArrow(
        _encode_short(vocabulary, with_ids), out
    )
    whole_key = F.xxhash64(*keep, "text").alias("row_key")
    cut = rows.filter(F.length("text") > leaf).select("*", whole_key)
    leaves = cut.mapInArrow(_cut(leaf), f"{own}, row_key long, leaf int, piece string")
    encoded = leaves.repartition("row_key", "leaf").mapInArrow(
        _encode_leaves(vocabulary, edge), f"{own}, row_key long, leaf int, piece string, {LEAVES}"
    )
    together = encoded.repartition("row_key").sortWithinPartitions("row_key", "leaf")
    long = together.mapInArrow(_join_leaves(vocabulary, list(keep), with_ids, out), out)
    return short.unionByName(long)


def op10_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents", "doc_id", "text")
    return encode(docs, public_tokenizers.path("word_bpe_49k.json"))
