"""BPE encoding and decoding with forced boundaries.

Two neighbouring byte symbols that stand side by side in no token of the vocabulary can never be merged, nor can
anything that holds both. So every word is cut at such pairs for certain, the fragments are encoded independently,
and the ids are concatenated. Fragments recur far more often than words, which makes their results worth keeping.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.columns import Compute, add_columns

# Bytes of results that a task keeps, of chunks between white space and of fragments, and what an entry of the latter
# takes beside its key and value.
KEPT_CHUNKS = 16 << 20
KEPT_FRAGMENTS = 28 << 20
ENTRY_BYTES = 200
# Unknown chunks that are worked out at once, and bytes of the rows that are encoded at once.
NEW_CHUNKS = 1 << 13
ENCODED_BYTES = 4 << 20
# Symbols of a fragment that is merged together with others.
SHORT = 24

# Blocks in which the tokenizers library lowers letters that are newer than Python's tables.
_NEWER_LETTERS = re.compile("[\u1c89\ua7c0-\ua7ff\U00010d50-\U00010d65\U00016ea0-\U00016eb8]")


# Marks behind a word that cut it off for certain; no pattern of a vocabulary joins them to letters.
_ENDINGS = frozenset(",.;:!?")


def _is_latin1(text: str) -> bool:
    """Whether all characters are below U+0100, where every text is composed."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    shown_set = set(shown)
    return [chr(b) if b in shown_set else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """The vocabulary file of a BPE with word ends, as the operators need it."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or [
            s["type"] for s in splits
        ] != ["Split", "ByteLevel"] or not model["end_of_word_suffix"]:
            raise ValueError("not a lower-casing byte-level BPE with word ends and no decoder")
        self.end: str = model["end_of_word_suffix"]
        self.pattern: str = splits[0]["pattern"]["Regex"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ranks = {tuple(m): rank for rank, m in enumerate(model["merges"])}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        # Which pairs of bytes stand side by side in a token, and which at a token's very end where a word ends.
        self.inside, self.at_end = np.zeros((256, 256), dtype=bool), np.zeros((256, 256), dtype=bool)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        for token in self.ids:
            shown = [byte[c] for c in token.removesuffix(self.end)]
            pairs = list(zip(shown, shown[1:]))
            if pairs and token.endswith(self.end):
                self.at_end[pairs.pop()] = True
            for pair in pairs:
                self.inside[pair] = True


class Merger:
    """Merges many fragments at once: their symbols stand one behind the other, linked to their neighbours.

    Every round merges one pair in each fragment that still has one, that of the lowest rank, leftmost first. Ranks
    are looked up anew only beside the merge.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = self.v = vocabulary
        self.never = len(v.ranks)
        order = len(v.tokens) + 1
        pairs = [(v.ids[x], v.ids[y], v.ids[x + y], rank) for (x, y), rank in v.ranks.items()]
        left, right, into, rank = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 4).T
        self.order, self.keys, self.rank = order, left * order + right, rank
        self.into = np.empty(self.never, dtype=np.int64)
        self.into[rank] = into
        shown = self.shown = byte_symbols()
        # Ids of the 256 symbols inside a word and of the 256 that end one.
        self.first = np.array([v.ids.get(c, -1) for c in [*shown, *(c + v.end for c in shown)]], dtype=np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.order + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank[at], self.never)

    def merge(self, fragments: Sequence[bytes]) -> list[bytes]:
        """The ids of each fragment as 32-bit numbers; a fragment that ends a word has a space behind it."""
        short = [f for f in fragments if len(f) <= SHORT]
        found = iter(self._merge_short(short))
        return [next(found) if len(f) <= SHORT else self._merge_long(f) for f in fragments]

    def _merge_short(self, fragments: Sequence[bytes]) -> list[bytes]:
        byte = np.frombuffer(b"".join(fragments) + b"\0", dtype=np.uint8)
        symbol = byte[:-1] != 0x20
        ids = self.first[byte[:-1].astype(np.int64) + 256 * (byte[1:] == 0x20)][symbol]
        ends = np.cumsum([len(f) for f in fragments], dtype=np.int64)
        sizes = np.diff(np.cumsum(symbol)[ends - 1], prepend=0)
        owner = np.repeat(np.arange(len(fragments)), sizes)
        # One more place, which is nobody's, stands for no neighbour.
        none = len(ids)
        ids, owner = np.append(ids, -1), np.append(owner, -1)
        after, before = np.arange(1, none + 2), np.arange(-1, none)
        after[-1] = before[0] = none
        ranks = np.full(none + 1, self.never)
        beside = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[beside] = self.ranks_of(ids[beside], ids[beside + 1])
        alive = np.ones(none + 1, dtype=bool)
        places = np.flatnonzero(np.isin(owner, owner[ranks < self.never])) if none else np.zeros(0, dtype=np.int64)
        while len(places):
            held, own = ranks[places], owner[places]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            lengths = np.diff(np.append(starts, len(places)))
            best = np.minimum.reduceat(held, starts)
            least = np.flatnonzero((held == np.repeat(best, lengths)) & (held < self.never))
            at = places[least[np.append(True, np.diff(own[least]) != 0)[: len(least)]]]
            going = np.repeat(best < self.never, lengths)
            into, gone = self.into[ranks[at]], after[at]
            ids[at], alive[gone], ranks[gone] = into, False, self.never
            behind = after[gone]
            after[at] = behind
            inside = owner[behind] == owner[at]
            before[behind[inside]] = at[inside]
            ranks[at] = np.where(inside, self.ranks_of(into, ids[behind]), self.never)
            ahead = before[at]
            inside = owner[ahead] == owner[at]
            ahead, into = ahead[inside], into[inside]
            ranks[ahead] = self.ranks_of(ids[ahead], into)
            places = places[going & alive[places]]
        kept = (alive & (ids >= 0))[:none]
        flat = ids[:none][kept].astype(np.int32).tobytes()
        bounds = np.append(0, 4 * np.cumsum(np.bincount(owner[:none][kept], minlength=len(fragments)))).tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def _merge_long(self, fragment: bytes) -> bytes:
        """The same merges from a queue, whose cost hardly grows faster than the fragment."""
        parts: list[str | None] = [self.shown[b] for b in fragment.removesuffix(b" ")]
        parts[-1] += self.v.end * fragment.endswith(b" ")
        n, ranks, ids = len(parts), self.v.ranks, self.v.ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(ranks[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(queue, (rank, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (rank := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(queue, (rank, h, parts[h], parts[i]))
        return np.array([ids[p] for p in parts if p is not None and p in ids], dtype=np.int32).tobytes()


class Kept:
    """Results by key within a bound of bytes. When half of it is full, what has not been asked for since the last
    time goes."""

    def __init__(self, most: int) -> None:
        self.most, self.held = most, 0
        self.recent: dict = {}
        self.earlier: dict = {}

    def missing(self, keys: Iterable) -> list:
        """The keys that are not known; known ones count as asked for, and are in ``recent`` afterwards."""
        recent, earlier = self.recent, self.earlier
        other = [key for key in keys if key not in recent]
        again = [key for key in other if key in earlier]
        self.add(again, [earlier[key] for key in again])
        return [key for key in other if key not in recent] if again else other

    def add(self, keys: Sequence, values: Sequence) -> None:
        self.recent.update(zip(keys, values))
        self.held += ENTRY_BYTES * len(keys) + sum(map(len, keys)) + sum(map(len, values))

    def settle(self) -> None:
        """To be called when nothing in ``recent`` is needed at once."""
        if self.held > self.most // 2:
            self.earlier, self.recent, self.held = (self.recent, {}, 0) if self.held <= self.most else ({}, {}, 0)


class KeptChunks:
    """Ids by chunk within a bound of bytes, in Arrow arrays: some 30 bytes an entry, where a dict takes 200.

    When it is full, what has not been asked for again since the last time goes.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.asked = np.zeros(0, dtype=bool)

    @property
    def held(self) -> int:
        return self.keys.nbytes + self.ids.nbytes + self.asked.nbytes

    @property
    def recent(self) -> dict[str, bytes]:
        """What has been asked for again since the store was last full."""
        return self._entries(self.asked)

    @property
    def earlier(self) -> dict[str, bytes]:
        return self._entries(~self.asked)

    def _entries(self, which: np.ndarray) -> dict[str, bytes]:
        return dict(zip(self.keys.filter(pa.array(which)).to_pylist(), self.ids.filter(pa.array(which)).to_pylist()))

    def places(self, keys: pa.Array) -> np.ndarray:
        """Where each key stands, -1 if it is not known; known ones count as asked for."""
        found = np.asarray(pc.fill_null(pc.index_in(keys, value_set=self.keys), -1)).astype(np.int64)
        self.asked[found[found >= 0]] = True
        return found

    def missing(self, keys: Sequence[str]) -> list[str]:
        found = self.places(pa.array(keys, pa.large_string()))
        return [key for key, place in zip(keys, found.tolist()) if place < 0]

    def add(self, keys: pa.Array, ids: Sequence[pa.Array]) -> None:
        self.keys, self.ids = pa.concat_arrays([self.keys, keys]), pa.concat_arrays([self.ids, *ids])
        self.asked = np.append(self.asked, np.zeros(len(keys), dtype=bool))

    def settle(self) -> None:
        if self.held > self.most:
            again = pa.array(self.asked)
            self.keys, self.ids = self.keys.filter(again), self.ids.filter(again)
            self.asked = np.zeros(len(self.keys), dtype=bool)
            if self.held > self.most // 2:
                self.clear()


class Encoder:
    """Ids of texts; keeps what it has worked out, within bounds."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex
        from tokenizers import Regex, normalizers, pre_tokenizers

        self.v, self.merger = vocabulary, Merger(vocabulary)
        self.find_words = regex.compile(vocabulary.pattern).findall
        # Unicode grows: what characters that Python's tables lack are is for the library's own tables to say.
        self.newer_words = pre_tokenizers.Split(Regex(vocabulary.pattern), "removed", invert=True).pre_tokenize_str
        self.newer_lower = normalizers.Lowercase().normalize_str
        self.not_space = regex.compile(r"\S+").findall
        self.marks = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))))
        self.newer_composed = normalizers.NFC().normalize_str
        self.combining = regex.compile(r"\p{M}").search
        # By chunk between white space, and by fragment.
        self.chunks, self.fragments = KeptChunks(KEPT_CHUNKS), Kept(KEPT_FRAGMENTS)

    def cuts(self, words: bytes) -> np.ndarray:
        """Where fragments end: at pairs of bytes that no token holds. Every word has a space behind it."""
        byte = np.frombuffer(words + b"  ", dtype=np.uint8)
        first, second = byte[:-3], byte[1:-2]
        held = np.where(byte[2:-1] == 0x20, self.v.at_end[first, second], self.v.inside[first, second])
        held = (held & (first != 0x20)) | (second == 0x20)
        return np.append(np.flatnonzero(~held) + 1, len(words))

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk by the vocabulary's pattern."""
        if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
            return [word for word, _ in self.newer_words(chunk)]
        return self.find_words(chunk)

    def spaced(self, chunk: str) -> str:
        """The words of a chunk with a space between; those of letters with one mark behind them are both."""
        if chunk.isalpha():
            return chunk
        if chunk[-1] in _ENDINGS and chunk[:-1].isalpha():
            return f"{chunk[:-1]} {chunk[-1]}"
        return " ".join(self.words(chunk))

    def ids_of(self, chunks: pa.Array) -> pa.Array:
        """The ids of each of these different chunks as 32-bit numbers; works out those that are not known yet.

        An empty chunk has none (null).
        """
        places = self.chunks.places(chunks)
        unknown = (places < 0) & (np.asarray(pc.binary_length(chunks)) > 0)
        new = chunks.filter(pa.array(unknown))
        places[unknown] = len(self.chunks.keys) + np.arange(len(new))
        self.chunks.add(new, [self._work_out(new[i : i + NEW_CHUNKS].to_pylist()) for i in range(0, len(new), NEW_CHUNKS)])
        found = self.chunks.ids.take(pa.array(places, mask=places < 0))
        self.chunks.settle()
        return found

    def _work_out(self, new: list[str]) -> pa.Array:
        words = [self.spaced(chunk).encode() for chunk in new]
        joined = b" ".join(words) + b" "
        ends = self.cuts(joined)
        bounds = [0, *ends.tolist()]
        fragments = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        unknown = self.fragments.missing(set(fragments))
        self.fragments.add(unknown, self.merger.merge(unknown))
        ids = list(map(self.fragments.recent.__getitem__, fragments))
        self.fragments.settle()
        last = np.searchsorted(ends, np.cumsum([len(w) + 1 for w in words])) + 1
        sizes = np.append(0, np.cumsum([len(i) for i in ids]))[np.append(0, last)]
        return pa.Array.from_buffers(
            pa.large_binary(), len(new), [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(b"".join(ids))])

    def normal(self, text: str) -> str:
        """What the normaliser leaves of the text, with no other white space than that of ASCII."""
        if text.isascii() or _is_latin1(text) and "\x85" not in text and "\xa0" not in text:
            text = text.lower()
        else:
            # Marks that the library's older tables lack neither compose nor change places there.
            compose = self.newer_composed if self.combining(text) else partial(unicodedata.normalize, "NFC")
            # A capital sigma is lowered alone, without a look at where in the word it stands.
            text = compose(text).replace("Σ", "σ")
            text = self.newer_lower(text) if _NEWER_LETTERS.search(text) else text.lower()
            return " ".join(self.not_space(text))
        return text

    def pieces(self, text: str) -> list[str | int]:
        """The text between special tokens, and the ids of those."""
        found, at = [], 0
        for mark in self.marks.finditer(text):
            found += [text[at : mark.start()], self.v.special[mark[0]]]
            at = mark.end()
        return [*found, text[at:]]

    def encode_flat(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids end, and the ids of all texts in one array."""
        marked = [i for i, t in enumerate(texts) if "<" in t and self.marks.search(t)]
        if not marked:
            return self._encode_unmarked(texts)
        cut = [self.pieces(t) if i in set(marked) else [t] for i, t in enumerate(texts)]
        ends, ids = self._encode_unmarked([p for pieces in cut for p in pieces if isinstance(p, str)])
        starts, found, sizes = iter(zip(np.append(0, ends), ends)), [], []
        for pieces in cut:
            own = [np.array([p], dtype=np.int32) if isinstance(p, int) else ids[slice(*next(starts))] for p in pieces]
            found += own
            sizes.append(sum(map(len, own)))
        return np.cumsum(sizes), np.concatenate(found)

    def _encode_unmarked(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pa.array([self.normal(t) for t in texts], pa.large_string()))
        bounds, chunks = np.asarray(split.offsets), split.flatten().dictionary_encode()
        del split
        found = self.ids_of(chunks.dictionary).take(chunks.indices)
        del chunks
        if not (len(found) and (size := pc.sum(pc.binary_length(found)).as_py())):
            return np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=np.int32)
        _, ends, ids = found.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[bounds[1:]] >> 2
        ids = np.frombuffer(ids, dtype=np.int32, count=size >> 2)
        del found
        pa.default_memory_pool().release_unused()
        return ends, ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers."""
        ends, ids = self.encode_flat(texts)
        return [ids[a:b].tobytes() for a, b in zip(np.append(0, ends), ends)]


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(Vocabulary(vocabulary))


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids",
           keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the token ids of each text, as the tokenizers library gives them without added special tokens.

    A null or empty text has no ids. A special token's own string in a text becomes its id. Texts are never cut
    short; repeated rows stay; a column that has the name of ``ids`` is replaced. The driver reads the vocabulary
    (a file of fixed size) and broadcasts it.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def make() -> Compute:
        encoder = encoder_of(shared.value)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            ends, found = encoder.encode_flat([t or "" for t in batch.column(text).to_pylist()])
            return [pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), found)]

        return compute

    fields = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), True))])
    return add_columns(docs, text, fields, make, keep, ENCODED_BYTES)


def decode(docs: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded",
           keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the text that the ids stand for, special tokens included: the tokens, with a space between.

    That is what decode() gives for a vocabulary without a decoder. Null ids give an empty text, and ids that are
    null or outside the vocabulary are left out, as the library does. The driver reads the vocabulary and broadcasts
    its tokens by id, all that a task needs of it.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        tokens = Vocabulary(file.read()).tokens
    shared = docs.sparkSession.sparkContext.broadcast([tokens.get(i, "") for i in range(max(tokens) + 1)])
    kept = [c for c in docs.columns if c.lower() != text.lower() and (keep is None or c in keep)]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(text, T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        names = np.array(shared.value, dtype=object)
        for batch in batches:
            texts = []
            for row in batch.column(ids):
                known = np.asarray([] if row.values is None else row.values.drop_null(), dtype=np.int64)
                known = known[(known >= 0) & (known < len(names))]
                texts.append(" ".join(names[known].tolist()))
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema=arrow)

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary_path: str, text: str = "text",
               keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    encoded = encode(docs, vocabulary_path, text, "ids", keep)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    measured = encoded.withColumns({
        "n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(joined.cast("binary"), 256),
    })
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    names = [*(c for c in keep), "n_tokens", "ids_sha256"]
    return decode(measured, vocabulary_path, keep=names).select(*names, digest.alias("decoded_sha256"))
