"""Cross-tokenizer alignment: two tokenizations of each text, cut where both have a token end.

Tokenizer A is a byte-level BPE and takes a blank and the text, B a piece BPE with byte fallback that adds
the blank itself, so both spell the same bytes. Byte offsets where tokens of both end cut the two streams into
groups; the two tokens that end there are a link.

**Fragments.** A byte range of a document gives a fragment: an open prefix (the tokens up to the first common
end in the range), closed groups with their links, and an open suffix (the tokens after the last common end).
Fragments of neighbouring ranges compose: the left suffix and the right prefix are one stretch of tokens, which
is cut at its own common ends, and what lies between two cuts is closed. Composition is associative, the
fragment without tokens is neutral, and the start of a document is a fragment that is cut and has nothing else.
A text of up to ``CHUNK`` characters is one fragment. Longer ones are cut into ranges, dealt over tasks, and
their fragments composed by a tree of shuffles, ``FAN`` neighbours at once. The two tokenizers' ranges are cut at different
places, each at the first one behind a multiple of ``CHUNK`` where that tokenizer surely starts anew, so
prefixes and suffixes are really open.

**Tokens.** No merge of either tokenizer crosses a blank between two characters that aren't white space: A's
pattern ends there, and no piece of B has a blank behind another character (checked when it is loaded). So
ranges that are cut there have the tokens of the whole text. A's merges are in the order of their ids (checked), so its
vocabulary is used as ranks.

**Counts.** Two linked tokens spell the same last bytes, so the shorter is a suffix of the longer, and the id pairs that can
be linked are bounded by the vocabularies, 324,300 for those of 50,256 and 32,000 tokens. Tasks count links in numbers per pair,
the sums are added by a shuffle, and the finished table, of that bound whatever the corpus, goes to each task.

Defined cases: null and empty texts, and texts whose tokens of A or B spell other bytes than a blank and the
text, have no tokens: zeros and no groups. Repeated rows count each. Special tokens' strings are plain
text. A stretch without any blank is handled by one task, however long. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import scan
from citeloom.llm.dart_minhash import node_of
from citeloom.llm.graphs import written

#: Characters of a range of a long document.
CHUNK = 1 << 16
#: Fragments composed in one task of the tree.
FAN = 32
#: The file names of the two tokenizers in their folder.
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: The pattern that splits a text before byte-level merges, and the bytes that stand for themselves there.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))

#: Where each tokenizer surely starts anew. A's pattern also ends between a letter or digit and a sign.
_A_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=[A-Za-z0-9ぁ-ゖァ-ヺ一-鿿])(?=[!-/:-@、。！，？])")
_B_CUT = re.compile(r"(?<=\S)(?= \S)")


def per_worker(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, once in a Python worker; functions sent to tasks don't share globals."""
    store = sys.modules.setdefault("_citeloom_llm_worker", types.ModuleType("_citeloom_llm_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


class _Tokens:
    """Tokens of texts; ``spelled`` has the bytes of each id."""

    spelled: list[bytes]

    def _ready(self) -> None:
        self.length = np.array([len(s) for s in self.spelled], np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _spells(self, ids: list[int], text: str) -> bool:
        return b"".join([self.spelled[i] for i in ids]) == text.encode()

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of each text; None if they don't spell it."""
        return [np.array(ids, np.int32) if self._spells(ids, text) else None
                for text, ids in zip(texts, self._encode(texts), strict=True)]


class ByteBpe(_Tokens):
    """A byte-level BPE from its tokenizer file."""

    def __init__(self, raw: bytes):
        import tiktoken

        data = json.loads(raw)
        model, before = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or data["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE")
        signs = {chr(b): b for b in _PLAIN_BYTES}
        signs |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in _PLAIN_BYTES)}
        special = {t["id"]: t["content"] for t in data["added_tokens"]}
        ranks = {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
            raise ValueError("the merges are not in the order of their ids")
        self.spelled = [b""] * (max([*model["vocab"].values(), *special]) + 1)
        for token, i in ranks.items():
            self.spelled[i] = token
        for i, token in special.items():
            self.spelled[i] = token.encode()
        self._bpe = tiktoken.Encoding("byte-bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._ready()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [self._bpe.encode_ordinary(t) for t in texts]

    def _spells(self, ids: list[int], text: str) -> bool:
        return True  # without a normalizer, a byte-level BPE spells what it reads


class PieceBpe(_Tokens):
    """A piece BPE from its model file; it adds a blank in front of what it gets."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=raw)
        pieces = [self._pieces.id_to_piece(i) for i in range(self._pieces.vocab_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece reaches over a blank")
        self.spelled = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self._ready()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return self._pieces.encode([t[1:] for t in texts], num_threads=1)


@dataclass
class Stretch:
    """Tokens of both tokenizers and the byte offsets of their ends in the document."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Stretch) -> Stretch:
        return Stretch(*(np.concatenate(p) for p in zip(vars(self).values(), vars(other).values(), strict=True)))


def _nothing() -> Stretch:
    return Stretch(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))


@dataclass
class Groups:
    """Closed groups: their text in pieces, their links, and the numbers of tokens and groups."""

    text: tuple[bytes, ...] = ()
    links: tuple[np.ndarray, ...] = ()
    n_a: int = 0
    n_b: int = 0
    n: int = 0

    def __add__(self, other: Groups) -> Groups:
        return Groups(*(x + y for x, y in zip(vars(self).values(), vars(other).values(), strict=True)))


@dataclass
class Fragment:
    """Open prefix, closed groups, open suffix; without a cut, all tokens are in the prefix."""

    prefix: Stretch = field(default_factory=_nothing)
    cut: bool = False
    groups: Groups = field(default_factory=Groups)
    suffix: Stretch = field(default_factory=_nothing)
    bad: bool = False


class Composer:
    """The composition of fragments, for vocabularies of two sizes."""

    def __init__(self, n_a: int, n_b: int):
        self.n_b, self.n_ids = n_b, max(n_a, n_b)
        self.link_type = link_type(n_a, n_b)
        self._signs = [f"{i}{sign}".encode() for sign in ",|;" for i in range(self.n_ids)]

    def start(self) -> Fragment:
        """The fragment in front of a document."""
        return Fragment(cut=True)

    def _close(self, s: Stretch) -> Fragment:
        """The fragment of a stretch, cut at its common ends."""
        if not len(s.a) or not len(s.b):
            return Fragment(prefix=s)
        at = np.minimum(np.searchsorted(s.b_ends, s.a_ends), len(s.b_ends) - 1)
        a_last = np.flatnonzero(s.b_ends[at] == s.a_ends)
        if not len(a_last):
            return Fragment(prefix=s)
        b_last = at[a_last]
        i, j, k, m = int(a_last[0]) + 1, int(b_last[0]) + 1, int(a_last[-1]) + 1, int(b_last[-1]) + 1
        return Fragment(Stretch(s.a[:i], s.a_ends[:i], s.b[:j], s.b_ends[:j]), True,
                        self._grouped(s.a[i:k], a_last[1:] + 1 - i, s.b[j:m], b_last[1:] + 1 - j),
                        Stretch(s.a[k:], s.a_ends[k:], s.b[m:], s.b_ends[m:]))

    def _grouped(self, a: np.ndarray, a_stops: np.ndarray, b: np.ndarray, b_stops: np.ndarray) -> Groups:
        """Tokens in groups that end before the given places."""
        if not len(a_stops):
            return Groups()
        n_a, n_b = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
        starts = a_stops + b_stops - n_a - n_b
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(starts - (a_stops - n_a), n_a)] = a
        codes[np.arange(len(b)) + np.repeat(starts + n_a - (b_stops - n_b), n_b)] = b
        codes[starts + n_a - 1] += self.n_ids
        codes[starts + n_a + n_b - 1] += 2 * self.n_ids
        links = a[a_stops - 1].astype(self.link_type) * self.n_b + b[b_stops - 1]
        return Groups((b"".join(map(self._signs.__getitem__, codes.tolist()))[:-1],), (links,), len(a), len(b), len(a_stops))

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of two neighbouring ranges."""
        if left.bad or right.bad:
            return Fragment(bad=True)
        middle = self._close((left.suffix if left.cut else left.prefix) + right.prefix)
        if not left.cut:
            # A cut on the right is a common end, so the middle has one as well.
            return middle if not right.cut else Fragment(middle.prefix, True, middle.groups + right.groups, right.suffix)
        if not middle.cut:
            return Fragment(left.prefix, True, left.groups, middle.prefix)
        one = middle.prefix
        closed = self._grouped(one.a, np.array([len(one.a)]), one.b, np.array([len(one.b)]))
        return Fragment(left.prefix, True, left.groups + closed + middle.groups + right.groups,
                        right.suffix if right.cut else middle.suffix)

    def finish(self, fragment: Fragment) -> tuple[int, int, int, bytes, np.ndarray]:
        """``(n_a, n_b, n_groups, groups, links)`` of a whole document; zeros where its tokens spell something else."""
        done = self.compose(self.start(), fragment)
        if done.bad or len(done.suffix.a) or len(done.suffix.b):
            return 0, 0, 0, b"", np.zeros(0, self.link_type)
        g = done.groups
        return g.n_a, g.n_b, g.n, b";".join(g.text), np.concatenate([np.zeros(0, self.link_type), *g.links])


class Aligner(Composer):
    """Fragments of texts by one pair of tokenizers, and their composition."""

    def __init__(self, a: _Tokens, b: _Tokens):
        super().__init__(len(a.spelled), len(b.spelled))
        self.a, self.b = a, b

    def fragments(self, a_texts: list[str], a_starts: list[int], b_texts: list[str], b_starts: list[int]) -> Iterator[Fragment]:
        """Of A's tokens of one range and B's of another; both start at byte offsets of one document."""
        for a, a_start, b, b_start in zip(self.a.ids(a_texts), a_starts, self.b.ids(b_texts), b_starts, strict=True):
            if a is None or b is None:
                yield Fragment(bad=True)
            else:
                yield self._close(Stretch(a, a_start + np.cumsum(self.a.length[a]), b, b_start + np.cumsum(self.b.length[b])))


def link_type(n_a: int, n_b: int) -> type:
    """A link is one number, the id of A times the size of B plus the id of B."""
    return np.int32 if n_a * n_b < 1 << 31 else np.int64


def ranges(text: str, chunk: int = CHUNK) -> list[tuple[int, int, int, int]]:
    """``(A's start, A's stop, B's start, B's stop)`` in characters of each range of a blank and the text."""
    size = len(text)
    edges = []
    for pattern in (_A_CUT, _B_CUT):
        found, at = [0], 0
        for nominal in range(chunk, size, chunk):
            if at < nominal:
                match = pattern.search(text, nominal)
                at = match.start() if match else size
            found.append(at)
        edges.append([*found, size])
    (a, b) = edges
    return list(zip(a, a[1:], b, b[1:], strict=False))


# --- on Spark -----------------------------------------------------------------

_STRETCH = ("a", "a_ends", "b", "b_ends")
_OUT_BYTES = 8 << 20
#: Documents whose links are looked up at once.
_SCORED = 256


def _fragment_schema(link: str) -> str:
    sides = ", ".join(f"{s}_{n} array<{'long' if n.endswith('ends') else 'int'}>" for s in ("prefix", "suffix") for n in _STRETCH)
    return f"node binary, chunk long, cut boolean, bad boolean, n_a long, n_b long, n long, groups binary, links array<{link}>, {sides}"


def _pack(rows: list[tuple[bytes, int, Fragment]], link: type) -> pa.RecordBatch:
    fragments = [r[2] for r in rows]
    columns = {
        "node": pa.array([r[0] for r in rows], pa.binary()), "chunk": pa.array([r[1] for r in rows], pa.int64()),
        "cut": pa.array([f.cut for f in fragments], pa.bool_()), "bad": pa.array([f.bad for f in fragments], pa.bool_()),
        **{n: pa.array([getattr(f.groups, n) for f in fragments], pa.int64()) for n in ("n_a", "n_b", "n")},
        "groups": pa.array([b";".join(f.groups.text) for f in fragments], pa.binary()),
        "links": pa.array([np.concatenate([np.zeros(0, link), *f.groups.links]) for f in fragments], pa.list_(pa.from_numpy_dtype(link)))}
    for side in ("prefix", "suffix"):
        for name in _STRETCH:
            kind = pa.int64() if name.endswith("ends") else pa.int32()
            columns[f"{side}_{name}"] = pa.array([getattr(getattr(f, side), name) for f in fragments], pa.list_(kind))
    return pa.RecordBatch.from_pydict(columns)


def _unpack(batch: pa.RecordBatch) -> list[tuple[bytes, int, Fragment]]:
    at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    plain = {n: at[n].to_pylist() for n in ("node", "chunk", "cut", "bad", "n_a", "n_b", "n", "groups")}
    rows = []
    for i in range(batch.num_rows):
        prefix, suffix = (Stretch(*(at[f"{s}_{n}"][i].values.to_numpy() for n in _STRETCH)) for s in ("prefix", "suffix"))
        text, links = plain["groups"][i], at["links"][i].values.to_numpy()
        groups = Groups((text,) if text else (), (links,), plain["n_a"][i], plain["n_b"][i], plain["n"][i])
        rows.append((plain["node"][i], plain["chunk"][i], Fragment(prefix, plain["cut"][i], groups, suffix, plain["bad"][i])))
    return rows


class Pair:
    """The files of two tokenizers as a broadcast; tasks need no file of their own."""

    def __init__(self, spark, folder: str, a_file: str = A_FILE, b_file: str = B_FILE):
        files = []
        for name in (a_file, b_file):
            with open(f"{folder}/{name}", "rb") as f:
                files.append(f.read())
        self._files = spark.sparkContext.broadcast(tuple(files))
        made = self.aligner()
        self.n_a, self.n_b = len(made.a.spelled), len(made.b.spelled)
        self.link = "int" if made.link_type is np.int32 else "long"

    def __getstate__(self) -> dict:
        return {"_files": self._files, "n_a": self.n_a, "n_b": self.n_b}

    def aligner(self) -> Aligner:
        files = self._files.value
        return per_worker((hash(files[0]), hash(files[1])), lambda: Aligner(ByteBpe(files[0]), PieceBpe(files[1])))

    def composer(self) -> Composer:
        """Without the tokenizers."""
        return per_worker((self.n_a, self.n_b), lambda: Composer(self.n_a, self.n_b))


def _results(ids: pa.Array, name: str, done: list[tuple], link: type) -> pa.RecordBatch:
    n_a, n_b, n_groups, groups, links = zip(*done, strict=True) if done else [()] * 5
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(n, pa.int64()) for n in (n_a, n_b, n_groups)), pa.array(groups, pa.binary()),
         pa.array(links, pa.list_(pa.from_numpy_dtype(link)))], names=[name, "n_a", "n_b", "n_groups", "groups", "links"])


def _short_texts(pair: Pair):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = pair.aligner()
        for batch in batches:
            for part in scan.slices(batch, "text"):
                texts = [f" {text}" if text else "" for text in part.column(1).to_pylist()]
                starts = [0] * len(texts)
                done = [aligner.finish(f) for f in aligner.fragments(texts, starts, texts, starts)]
                yield _results(part.column(0), "doc_id", done, aligner.link_type)

    return run


def _cut_ranges(chunk: int):
    """Long texts to a row per range: A's and B's parts lie in ``part``, from characters ``a0`` to ``a1`` and ``b0`` to ``b1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "chunk", "a_start", "b_start", "a0", "a1", "b0", "b1", "part"]
        for batch in batches:
            rows, held = [], 0
            for node, text in zip(batch.column(0), batch.column(1), strict=True):
                s = f" {text.as_py()}"
                offset = at = 0
                for k, (a0, a1, b0, b1) in enumerate(ranges(s, chunk)):
                    low, high = min(a0, b0), max(a1, b1)
                    offset, at = offset + len(s[at:low].encode()), low
                    starts = [offset + len(s[low:x].encode()) for x in (a0, b0)]
                    rows.append((node.as_py(), k, *starts, a0 - low, a1 - low, b0 - low, b1 - low, s[low:high]))
                    held += high - low
                    if held > _OUT_BYTES:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _RANGES)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], _RANGES)

    return run


_RANGES = pa.schema([("node", pa.binary()), *((n, pa.int64()) for n in ("chunk", "a_start", "b_start", "a0", "a1", "b0", "b1")), ("part", pa.string())])
_RANGES_DDL = "node binary, chunk long, a_start long, b_start long, a0 long, a1 long, b0 long, b1 long, part string"


def _fragments(pair: Pair):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = pair.aligner()
        for batch in batches:
            for part in scan.slices(batch, "part"):
                rows = part.to_pylist()
                a, b = ([r["part"][r[f"{s}0"] : r[f"{s}1"]] for r in rows] for s in "ab")
                made = aligner.fragments(a, [r["a_start"] for r in rows], b, [r["b_start"] for r in rows])
                yield _pack([(r["node"], r["chunk"], f) for r, f in zip(rows, made, strict=True)], aligner.link_type)

    return run


def _composed(pair: Pair, last: bool):
    """Neighbouring fragments of a document to one, or to the document's result."""

    def run(table: pa.Table) -> pa.Table:
        composer = pair.composer()
        rows = sorted((r for batch in table.to_batches() for r in _unpack(batch)), key=lambda r: r[1])
        node, chunk, done = rows[0]
        for _, _, fragment in rows[1:]:
            done = composer.compose(done, fragment)
        if last:
            made = _results(pa.array([node], pa.binary()), "node", [composer.finish(done)], composer.link_type)
        else:
            made = _pack([(node, chunk // FAN, done)], composer.link_type)
        return pa.Table.from_batches([made])

    return run


def align(docs: DataFrame, pair: Pair, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, groups, links)``, a row per row of ``docs``.

    ``groups`` spells the groups as ``a1,a2|b1;a3|b2``; ``links`` has a number per link, see :func:`link_type`.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = f"n_a long, n_b long, n_groups long, groups binary, links array<{pair.link}>"
    size = F.coalesce(F.length("text"), F.lit(0))
    rows = docs.select("doc_id", "text")
    short = rows.where(size <= chunk).mapInArrow(_short_texts(pair), f"doc_id {kind}, {found}")
    long = rows.where(size > chunk).withColumn("node", node_of(F.col("text")))
    longest = long.agg(F.max(F.length("text"))).first()[0]
    if longest is None:
        return short
    # Ranges of equal texts are tokenized once.
    parts = long.select("node", "text").mapInArrow(_cut_ranges(chunk), _RANGES_DDL).dropDuplicates(["node", "chunk"])
    fragments = parts.mapInArrow(_fragments(pair), _fragment_schema(pair.link))
    n = -(-(longest + 1) // chunk)
    while n > 1:
        n = -(-n // FAN)
        above = fragments.withColumn("above", F.floor(F.col("chunk") / FAN)).groupBy("node", "above")
        fragments = above.applyInArrow(_composed(pair, n == 1), f"node binary, {found}" if n == 1 else _fragment_schema(pair.link))
    return short.unionByName(long.select("doc_id", "node").join(fragments, "node").drop("node"))


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, int] = {}
    for batch in batches:
        links, counts = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        for link, n in zip(links.tolist(), counts.tolist(), strict=True):
            total[link] = total.get(link, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["link", "n"])


def link_counts(aligned: DataFrame, pair: Pair) -> DataFrame:
    """``(a, b, n, best)``: how many links hold an id pair, and whether no other pair of that id of B has more.

    One row per id pair that occurs; bounded by the vocabularies, not by the corpus.
    """
    sums = aligned.select("links").mapInArrow(_count_links, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))
    pairs = sums.select(F.floor(F.col("link") / pair.n_b).cast("int").alias("a"), (F.col("link") % pair.n_b).cast("int").alias("b"), "n")
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def score_links(aligned: DataFrame, counts: DataFrame, pair: Pair) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` and ``count_sum`` in place of the links."""
    table = counts.toArrow()
    links = table.column("a").to_numpy().astype(np.int64) * pair.n_b + table.column("b").to_numpy()
    order = np.argsort(links)
    known = aligned.sparkSession.sparkContext.broadcast(
        (links[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order]))
    others = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = known.value
        for batch in (whole.slice(k, _SCORED) for whole in batches for k in range(0, whole.num_rows, _SCORED)):
            column = batch.column(batch.schema.get_field_index("links"))
            sizes = column.value_lengths().to_numpy()
            at = np.searchsorted(keys, column.flatten().to_numpy())
            edges = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(v[at])])[edges] for v in (best.astype(np.int64), n)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
            columns += [pa.array(sizes, pa.int64()), *(pa.array(np.diff(s), pa.int64()) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "n_links", "n_best", "count_sum"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.mapInArrow(run, f"{kinds}, n_links long, n_best long, count_sum long")


def written_alignment(docs: DataFrame, pair: Pair, chunk: int = CHUNK) -> DataFrame:
    """:func:`align` as a table, with the digest of the groups in their place."""
    rows = align(docs, pair, chunk)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return written(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned", narrow=False)
