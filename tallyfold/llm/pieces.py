"""SentencePiece encoding by sampling, and lossless decoding.

All segmentations of a text into pieces form a lattice. A segmentation is drawn with probability
proportional to the product of its pieces' weights: forward filtering sums the weights of all paths to each
position, backward sampling walks from the end and picks each piece by its share. The draws are a
hash of the seed, the row key and the place in the text, so a row always gets the same segmentation,
however the rows are split into tasks and whichever executor computes it.

Weights: the logarithm of a piece's probability times ``ALPHA``. A model of kind BPE has no probabilities
but merge ranks as scores; there Zipf's law takes their place, log p = -log(rank + 2.7).

Blanks become U+2581 with one in front of the text. No piece holds U+2581 after another character,
so every path passes each start of a word and the lattice is the product of the lattices of the words
(words here: runs of U+2581 and what follows up to the next, cut further where no piece of the vocabulary goes
on). Each distinct word is filtered once per worker, all new words of a batch at once; so are all draws. Code points that are no piece, and a literal
U+2581, are spelt as their bytes. Decoding joins pieces and bytes, turns U+2581 to blanks and
drops the first; nothing is normalised, so it returns the text exactly.

Null texts have null pieces, empty texts none. A null key counts as a key of its own; rows with equal keys and
texts get equal pieces. Empty tables give empty results. Other columns are not read by ``encode``
and ``decode`` carries none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
SEED = 20_250_101
SPACE = "▁"
#: Longer runs without a blank are filtered each time, so the cache stays small.
SHORT, CACHED_CHARS, CACHED_NODES = 9, 48, 2_000_000
#: Characters of words that are filtered at once, unless a single word has more.
LATTICE_CHARS = 100_000
#: Shares and draws are whole multiples of 1 / GRID.
GRID_BITS = 30
GRID = float(1 << GRID_BITS)
#: Slots of the hash table of pieces.
TABLE = 1 << 19
#: Log weight of a byte.
RARE = -12.0
_MASK = (1 << 64) - 1


@dataclass
class Vocabulary:
    """Pieces by id with their log weights, byte pieces by value, and a hash table of all pieces.

    No piece joins a character of ``alone`` to another one, nor a letter to a mark of ``marks`` behind it.
    """

    ids: dict[str, int]
    weight: np.ndarray
    bytes_: list[int]
    texts: list[str]
    longest: int
    alone: str
    marks: str
    slots: np.ndarray
    held: np.ndarray


def read_vocabulary(model: bytes, alpha: float = ALPHA) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = sp.get_piece_size()
    scores = [sp.get_score(i) for i in range(size)]
    ranked = min(scores) < -1000  # merge ranks, not log probabilities
    texts, ids, weight, byte_ids = [], {}, np.full(size, -np.inf), [-1] * 256
    for i in range(size):
        text = sp.id_to_piece(i)
        texts.append(text)
        if sp.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            ids[text] = i
            weight[i] = alpha * (-math.log(-scores[i] + 2.7) if ranked else scores[i])
    if -1 in byte_ids:
        raise ValueError("the model has no byte pieces, so it cannot spell every text")
    if any(SPACE in t.lstrip(SPACE) for t in ids):
        raise ValueError("pieces that go on after a blank are not supported")
    joined = {c for t in ids if len(t) > 1 for c in t}
    alone = "".join(c for c in "\n\r\t" if c not in joined)
    behind = {b for t in ids for a, b in zip(t, t[1:], strict=False) if a.isalpha()}
    marks = "".join(c for c in ".,;:!?)\"" if c not in behind)
    longest = max(map(len, ids))
    slots, held = _table(ids, longest)
    return Vocabulary(ids, weight, byte_ids, texts, longest, alone, marks, slots, held)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _keys(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For each length, a hash of the characters that end at each place."""
    running = np.zeros(len(codes), np.uint64)
    for length in range(1, longest + 1):
        running[1:] = running[:-1].copy()
        running[:1] = 0
        running = running * np.uint64(0x9E3779B97F4A7C15) + codes + np.uint64(1)
        yield _mixed(running + np.uint64(length << 48))


def _table(ids: dict[str, int], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing: keys and ids."""
    slots, held = np.zeros(TABLE, np.uint64), np.full(TABLE, -1, np.int32)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    last = np.cumsum(lengths) - 1
    keys = np.empty(len(ids), np.uint64)
    for length, all_keys in enumerate(_keys(_codes("".join(ids)), longest), 1):
        keys[lengths == length] = all_keys[last[lengths == length]]
    for key, i in zip(keys.tolist(), ids.values(), strict=True):
        at = key % TABLE
        while held[at] >= 0:
            at = (at + 1) % TABLE
        slots[at], held[at] = key, i
    return slots, held


def _found(v: Vocabulary, keys: np.ndarray) -> np.ndarray:
    """Ids of pieces by hash, -1 where there is none."""
    at = (keys % np.uint64(TABLE)).astype(np.int64)
    out = v.held[at]
    # Most places are empty or hold the key; only the others look further along the chain.
    open_ = np.flatnonzero((out >= 0) & (v.slots[at] != keys))
    while len(open_):
        at[open_] = (at[open_] + 1) % TABLE
        out[open_] = v.held[at[open_]]
        open_ = open_[(out[open_] >= 0) & (v.slots[at[open_]] != keys[open_])]
    return out


def filtered(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, ...]:
    """Forward filtering of many words at once.

    A node is a character, standing for the position behind it. Returned are the last node of each word, the
    first edge of each node and, for all edges in the order of nodes: node plus running share (in whole units of ``GRID``, so that sums are exact
    and draws do not depend on what else is filtered), the node the edge comes from (-1: the start of the
    word) and its piece, or -2 minus a code point that has to be spelt in bytes.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = _codes("".join(words))
    n, ends = len(codes), np.cumsum(lengths)
    place = np.arange(n) - np.repeat(ends - lengths, lengths)
    # A column per length of piece, and one for the bytes of a character without a piece.
    longest = min(v.longest, int(lengths.max()))
    ids = np.full((n, longest + 1), -1, np.int32)
    for k, keys in enumerate(_keys(codes, longest)):
        long_enough = np.flatnonzero(place >= k)
        if not len(long_enough):
            break
        ids[long_enough, k] = _found(v, keys[long_enough])
    weight = np.where(ids >= 0, v.weight[ids], -np.inf)
    bare = np.flatnonzero(ids[:, 0] < 0)
    weight[bare, -1] = RARE * (1 + (codes[bare] > 0x7F) + (codes[bare] > 0x7FF) + (codes[bare] > 0xFFFF))
    ids[bare, -1] = -2 - codes[bare].astype(np.int64)
    back = np.concatenate([np.arange(1, longest + 1), [1]])

    total, share = np.zeros(n), np.empty(weight.shape)
    order = np.argsort(place, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(place))]) if n else [0]
    for at in range(len(cuts) - 1):
        rows = order[cuts[at] : cuts[at + 1]]
        before = np.where(back <= at, total[np.maximum(rows[:, None] - back, 0)], 0.0)
        sums = weight[rows] + before
        top = sums.max(1)
        parts = np.exp(sums - top[:, None])
        running = np.cumsum(parts, axis=1)
        total[rows] = top + np.log(running[:, -1])
        share[rows] = np.floor(running / running[:, -1:] * GRID) / GRID
    edge = np.isfinite(weight)
    node, kind = np.nonzero(edge)
    shares = node + share[edge]
    last = np.cumsum(edge.sum(1)) - 1
    shares[last] = np.arange(n) + 1.0
    came = np.where(back[kind] > place[node], -1, node - back[kind])
    return ends - 1, np.append(0, last[:-1] + 1), shares, came, ids[edge]


#: Stands for a literal U+2581 within a word. A lone surrogate: no text that Spark holds contains it.
_STAND_IN = "\udfff"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoder:
    """Encodes batches of texts; keeps the lattices of the words met so far."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.vocabulary, self.seed = vocabulary, seed
        alone, marks = re.escape(vocabulary.alone), re.escape(vocabulary.marks)
        # A word ends where no piece goes on: before U+2581, around lone characters, before a mark.
        ways = [f"[{alone}]"] if alone else []
        ways += [rf"{SPACE}*+[^\W\d_]++(?=[{marks}])"] if marks else []
        self.split = re.compile("|".join([*ways, f"{SPACE}*+[^{SPACE}{alone}]+", f"{SPACE}+"]))
        self.ends: dict[str, int] = {}
        self.arrays = _no_lattices()
        #: In how many batches a word was used, at its last node.
        self.uses = np.empty(0, np.int32)

    def words(self, text: str) -> list[str]:
        if SPACE in text:
            text = text.replace(SPACE, _STAND_IN)
        return self.split.findall(SPACE + text.replace(" ", SPACE))

    def _make_room(self) -> None:
        """Once the lattices held are over the bound, keep those that most batches used, up to half of it."""
        first, shares, came, ids, nodes = self.arrays
        if nodes <= CACHED_NODES:
            return
        names = list(self.ends)
        last = np.fromiter(self.ends.values(), np.int64, len(names))
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        uses = self.uses[last]
        # Words of one batch only go first; among equally used ones, all stay or none.
        order = np.argsort(-uses, kind="stable")
        fitting = np.cumsum(lengths[order]) <= CACHED_NODES // 2
        least = max(2, uses[order[fitting.argmin()]] + 1)
        stay = np.flatnonzero(uses >= least)
        kept = np.zeros(nodes + 1, np.int64)
        np.add.at(kept, last[stay] + 1, -1)
        np.add.at(kept, last[stay] - lengths[stay] + 1, 1)
        kept = np.cumsum(kept[:-1]) > 0
        to_new = np.cumsum(kept) - 1
        edges_of = np.diff(np.append(first, len(ids)))
        node = np.repeat(np.arange(nodes), edges_of)
        edge = kept[node]
        starts = np.cumsum(edges_of[kept]) - edges_of[kept]
        moved = shares[edge] - node[edge] + to_new[node[edge]]
        source = came[edge]
        source = np.where(source >= 0, to_new[source], -1).astype(np.int32)
        self.arrays = starts.astype(np.int32), moved, source, ids[edge], int(kept.sum())
        self.ends = {names[i]: int(to_new[last[i]]) for i in stay.tolist()}
        # Older use counts for less, so the words kept follow the texts.
        self.uses = self.uses[kept] // 2

    def _keep(self, words: list[str]) -> None:
        *arrays, nodes = self.arrays
        parts = [[x] for x in arrays]
        # Short words apart, as the work grows with the longest.
        for group in ([w for w in words if len(w) <= SHORT], [w for w in words if len(w) > SHORT]):
            if group:
                ends, first, shares, came, ids = filtered(self.vocabulary, group)
                self.ends.update(zip(group, (ends + nodes).tolist(), strict=True))
                edges = sum(map(len, parts[1]))
                new = (
                    (first + edges).astype(np.int32), shares + nodes,
                    np.where(came >= 0, came + nodes, -1).astype(np.int32), ids,
                )
                for part, column in zip(parts, new, strict=True):
                    part.append(column)
                nodes += int(ends[-1]) + 1
        self.arrays = (*map(np.concatenate, parts), nodes)
        self.uses = np.concatenate([self.uses, np.zeros(nodes - len(self.uses), np.int32)])

    def _long_words(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray, tuple]]:
        """Lattices of words that are not kept, in groups of bounded size: words, ends and arrays."""
        group, chars = [], 0
        for word in words:
            if group and chars + len(word) > LATTICE_CHARS:
                ends, *arrays = filtered(self.vocabulary, group)
                yield group, ends, tuple(arrays)
                group, chars = [], 0
            group.append(word)
            chars += len(word)
        if group:
            ends, *arrays = filtered(self.vocabulary, group)
            yield group, ends, tuple(arrays)

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each text has."""
        words: list[str] = []
        owners = []
        for text in texts:
            if text:
                words += self.words(text)
            owners.append(len(words))
        self._make_room()
        ends = list(map(self.ends.get, words))
        unknown = [i for i, e in enumerate(ends) if e is None]
        fresh = dict.fromkeys([words[i] for i in unknown])
        long = sorted([w for w in fresh if len(w) > CACHED_CHARS], key=len)
        if len(fresh) > len(long):
            self._keep([w for w in fresh if len(w) <= CACHED_CHARS])
        for i in unknown:
            ends[i] = self.ends.get(words[i], -1)
        at = np.array(ends, np.int64)
        per_text = np.diff(owners, prepend=0)
        owner = np.repeat(np.arange(len(texts)), per_text)
        place = np.arange(len(at)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        draw = _mixed(
            keys[owner] + np.uint64(self.seed) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        )
        short = np.flatnonzero(at >= 0)
        self.uses[at[short]] += 1  # once per batch, however often
        parts = [(short, *_walk(self.arrays, at[short], draw[short]))]
        rest = np.flatnonzero(at < 0)
        for group, last, arrays in self._long_words(long):
            number = {w: i for i, w in enumerate(group)}
            which = np.fromiter((number.get(words[i], -1) for i in rest.tolist()), np.int64, len(rest))
            here = rest[which >= 0]
            parts.append((here, *_walk(arrays, last[which[which >= 0]], draw[here])))
        word_of = np.concatenate([where[walk] for where, walk, _ in parts])
        ids = np.concatenate([got for _, _, got in parts])
        if len(parts) > 1:
            order = np.argsort(word_of, kind="stable")
            word_of, ids = word_of[order], ids[order]
        ids, counts = self._spelt(ids)
        whole = np.bincount(owner[word_of], counts, len(texts)) if len(ids) else np.zeros(len(texts))
        return ids, whole.astype(np.int64)

    def _spelt(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace code points by the ids of their bytes; how many ids stand for each entry."""
        counts = np.ones(len(ids), np.int64)
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids, counts
        spelt = {}
        for code in np.unique(ids[bare]).tolist():
            char = chr(-2 - code)
            raw = (SPACE if char == _STAND_IN else char).encode("utf-8", "surrogatepass")
            spelt[code] = [self.vocabulary.bytes_[b] for b in raw]
        counts[bare] = [len(spelt[c]) for c in ids[bare].tolist()]
        out = np.repeat(ids, counts)
        out[out < 0] = [b for c in ids[bare].tolist() for b in spelt[c]]
        return out, counts


def _no_lattices() -> tuple:
    return np.empty(0, np.int32), np.empty(0), np.empty(0, np.int32), np.empty(0, np.int32), 0


def _walk(arrays, at: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backward sampling from each end to the start: the walk and the piece of every step, in text order."""
    first, shares, came, ids = arrays[:4]
    active, walks, edges = np.arange(len(at)), [], []
    step = 0
    while len(active):
        u = _mixed(draw[active] + np.uint64(step * 0xD1342543DE82EF95 & _MASK))
        share = (u >> np.uint64(64 - GRID_BITS)).astype(np.float64) / GRID
        # The edge whose running share passes the draw: nodes have few edges, so they are tried in turn.
        drawn, edge = at + share, first[at].astype(np.int64)
        behind = np.flatnonzero(shares[edge] <= drawn)
        while len(behind):
            edge[behind] += 1
            behind = behind[shares[edge[behind]] <= drawn[behind]]
        walks.append(active)
        edges.append(edge)
        at = came[edge]
        on = at >= 0
        active, at = active[on], at[on]
        step += 1
    if not walks:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    # Each walk's last step is the first piece of its word: fill from the end of its room.
    walk, edge = np.concatenate(walks), np.concatenate(edges)
    sizes = np.bincount(walk, minlength=len(draw))
    step_of = np.repeat(np.arange(len(walks)), [len(w) for w in walks])
    room = np.empty(len(walk), np.int32)
    room[np.cumsum(sizes)[walk] - 1 - step_of] = ids[edge]
    return np.repeat(np.arange(len(draw)), sizes), room


def spelt_like(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray, texts: list[str | None]) -> list[bool | None]:
    """For each text, whether the bytes of its pieces, but for the blank in front, are its bytes; null for null."""
    blob, starts, sizes = _blob(vocabulary)
    lengths = sizes[ids]
    ends = np.cumsum(lengths)
    made = blob[np.repeat(starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
    borders = np.append(0, ends)[offsets].tolist()
    return [
        None if t is None else made[a + 1 : b] == t.encode("utf-8", "surrogatepass")
        for t, a, b in zip(texts, borders[:-1], borders[1:], strict=True)
    ]


def _blob(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces in a row, and where each starts and how many it has."""
    made = getattr(vocabulary, "_bytes_of", None)
    if made is None:
        spelt = _spellings(vocabulary)
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        made = np.frombuffer(b"".join(spelt), np.uint8), np.cumsum(sizes) - sizes, sizes
        vocabulary._bytes_of = made
    return made


def decode_ids(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of a sequence of piece ids; the inverse of encoding."""
    if not ids:
        return ""
    raw = b"".join(_spellings(vocabulary)[i] for i in ids)
    return raw.decode("utf-8", "surrogatepass")[1:]


def _spellings(vocabulary: Vocabulary) -> list[bytes]:
    """Bytes each piece stands for; U+2581 of a piece is a blank, spelt in bytes it is itself."""
    made = getattr(vocabulary, "_made", None)
    if made is None:
        made = [t.replace(SPACE, " ").encode() for t in vocabulary.texts]
        for value, i in enumerate(vocabulary.bytes_):
            made[i] = bytes([value])
        vocabulary._made = made
    return made


#: Encoders of this worker, by model and seed: lattices outlive a task.
_encoders: dict[tuple, Encoder] = {}


def _encoder(model: bytes, alpha: float, seed: int) -> Encoder:
    key = (hash(model), alpha, seed)
    if key not in _encoders:
        _encoders[key] = Encoder(read_vocabulary(model, alpha), seed)
    return _encoders[key]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``<key>, n_pieces, pieces array<int>`` and ``lossless``: whether decoding returns the text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(key, F.xxhash64(key).alias("_key"), "text")
    schema = rows.select(key).schema.simpleString()[7:-1].replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped.value, alpha, seed)
        for batch in batches:
            for part in row_slices(batch, 1_000_000):
                texts = part.column(2).to_pylist()
                keys = part.column(1).to_numpy().view(np.uint64)
                ids, counts = encoder.encode([t or "" for t in texts], keys)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                exact = spelt_like(encoder.vocabulary, ids, offsets, texts)
                null = np.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=np.append(null, False)) if null.any() else pa.array(offsets), pa.array(ids, pa.int32())
                )
                yield pa.record_batch(
                    [part.column(0), pa.array(counts.astype(np.int64), mask=null), lists, pa.array(exact, pa.bool_())],
                    names=[key, "n_pieces", "pieces", "lossless"],
                )

    return rows.mapInArrow(run, f"{schema}, n_pieces bigint, pieces array<int>, lossless boolean")


def decode(encoded: DataFrame, model: bytes, key: str = "doc_id") -> DataFrame:
    """``<key>, text`` from ``<key>, pieces``."""
    shipped = encoded.sparkSession.sparkContext.broadcast(model)
    rows = encoded.select(key, "pieces")
    schema = rows.select(key).schema.simpleString()[7:-1].replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(shipped.value, ALPHA, SEED).vocabulary
        for batch in batches:
            texts = [None if p.as_py() is None else decode_ids(vocabulary, p.as_py()) for p in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return rows.mapInArrow(run, f"{schema}, text string")


def op4_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), read_model())
