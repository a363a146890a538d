"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The transducer is the smallest acyclic automaton of the words, in which equal suffixes share states. Each
arc carries the number of words that sort before it from its state; the sum along a path is the word's rank, and ranks
point into a table of token ids. The file is written once to the shared folder, sent to the executors by
Spark's file distribution, and memory-mapped by their Python workers.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import kept, parts, texts_of
from allelon.llm.tokens import KEPT_LETTERS, WordTable, byte_letters, library_encoder
from allelon.llm.wordcount import LONG_WORD, word_counts
from allelon.storage import shared_dir, store

#: White space as the tokenizer's own pattern knows it, without the four separators that only Python counts.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT_SPACE = re.compile(f"[{_SPACE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Above all ranks.
NEVER = 1 << 60


def split_words(text: str) -> list[str]:
    """White-space separated words of a text."""
    if _SEPARATORS.search(text):
        return [w for w in _SPLIT_SPACE.split(text) if w]
    return text.split()


def word_keys(text: str) -> list[str]:
    """The words of a text as the lexicon knows them: ASCII words in lower case, others as they stand.

    No normal form joins characters across white space, so words are normalised one by one, when they are merged.
    """
    if text.isascii():
        return split_words(text.lower())
    return [w.lower() if w.isascii() else w for w in split_words(text)]


class WordBpe:
    """Exact merges for a tokenizer file with an end-of-word suffix, and its token strings.

    Words with other than ASCII letters are normalised and split by the library's own objects, as its Unicode tables are of
    another version than Python's.
    """

    def __init__(self, path: str):
        own = library_encoder(path)
        self.normaliser, self.splitter = own.normalizer, own.pre_tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Pair of ids -> rank and merged id in one number, so that the least number is the pair to merge.
        self.rank = {(self.vocab[a], self.vocab[b]): r << 20 | self.vocab[a + b] for r, (a, b) in enumerate(pairs)}
        self.piece = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.byte = {c: b for b, c in enumerate(byte_letters())}
        self.inner = [self.vocab.get(c) for c in byte_letters()]
        self.last = [self.vocab.get(c + self.suffix) for c in byte_letters()]
        self.pair_keys, self.pair_ranks = self._pair_table()
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def pieces(self, words: list[str], together: int = 512) -> list[list[bytes]]:
        """The parts of each word that are merged apart, in UTF-8; other than ASCII words go to the library ``together`` at a time."""
        out = [[p.encode() for p in self.piece.findall(w)] if w.isascii() else [] for w in words]
        rest = [i for i, w in enumerate(words) if not w.isascii()]
        for at in range(0, len(rest), together):
            part = rest[at : at + together]
            text = self.normaliser.normalize_str(" ".join(words[i] for i in part))
            ends = np.cumsum([len(w) + 1 for w in text.split(" ")]).tolist()
            k = 0
            for piece, (start, _) in self.splitter.pre_tokenize_str(text):
                while start >= ends[k]:
                    k += 1
                out[part[k]].append(bytes(map(self.byte.__getitem__, piece)))
        return out

    def merge_piece(self, data: bytes) -> list[int]:
        """Token ids of one piece: the pair of lowest rank is merged, leftmost first, until none is left."""
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        get = self.rank.get
        if len(ids) > 48:
            return self._merge_long(ids)
        ranks = [get(p, NEVER) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != NEVER:
            at = ranks.index(best)
            ids[at : at + 2] = [best & 0xFFFFF]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long pieces, with a heap over a linked list."""
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if (r := get(p))]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            new = ids[i] = r & 0xFFFFF
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if r := get((new, ids[after[j]])):
                    heapq.heappush(heap, (r, i, new, ids[after[j]]))
            if (p := before[i]) >= 0 and (r := get((ids[p], new))):
                heapq.heappush(heap, (r, p, ids[p], new))
        return [x for x, a in zip(ids, alive, strict=True) if a]

    def merge_word(self, word: str) -> list[int]:
        """Token ids of a word without white space."""
        out: list[int] = []
        for piece in self.pieces([word])[0]:
            out += self.merge_piece(piece)
        return out

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of ids as sorted numbers, and their entries in ``rank``."""
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        return keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def _merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of one length each: in each round, every piece merges its pair of lowest rank, leftmost first."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.array(self.inner, np.int64)[data]
        ends = np.cumsum(sizes) - 1
        ids[ends] = np.array(self.last, np.int64)[data[ends]]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ranks = np.full(len(ids), NEVER)  # of each symbol with the next one of its piece
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inside] = self._pair_ranks(ids[inside], ids[inside + 1])
        while True:
            starts = np.searchsorted(owner, np.arange(len(pieces)))
            best = np.minimum.reduceat(ranks, starts)[owner]
            at = np.flatnonzero((ranks == best) & (best != NEVER))
            if not len(at):
                break
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = ranks[at] & 0xFFFFF
            gone = np.ones(len(ids), bool)
            gone[at + 1] = False
            ids, owner, ranks = ids[gone], owner[gone], ranks[gone]
            at -= np.arange(len(at))  # each merge before has taken one symbol away
            near = np.concatenate([at, at[at > 0] - 1])
            near = near[near < len(ids) - 1]
            same = owner[near] == owner[near + 1]
            ranks[at[at == len(ids) - 1]] = NEVER
            ranks[near] = np.where(same, self._pair_ranks(ids[near], ids[near + 1]), NEVER)
        cuts = [*(4 * np.searchsorted(owner, np.arange(len(pieces)))).tolist(), 4 * len(ids)]
        flat = ids.astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def merge_words(self, words: list[str], together: int = 4096) -> list[bytes]:
        """Ids of many words, each as little-endian 32-bit integers; pieces of like lengths are merged together."""
        split = self.pieces(words)
        flat = [p for own in split for p in own]
        order = sorted(range(len(flat)), key=lambda i: len(flat[i]))
        found: list[bytes] = [b""] * len(flat)
        for a in range(0, len(order), together):
            part = order[a : a + together]
            if len(flat[part[-1]]) > 48:
                long = [i for i in part if len(flat[i]) > 48]
                part = part[: len(part) - len(long)]
                for i in long:
                    ids = self.merge_piece(flat[i])
                    found[i] = struct.pack(f"<{len(ids)}I", *ids)
            if part:
                for i, ids in zip(part, self._merge_many([flat[i] for i in part]), strict=True):
                    found[i] = ids
        out, at = [], 0
        for own in split:
            out.append(found[at] if len(own) == 1 else b"".join(found[at : at + len(own)]))
            at += len(own)
        return out


def compile_lexicon(words: Iterable[str], ids_of) -> bytes:
    """The transducer of ``words`` as one block of bytes: header, state and arc tables, id offsets, ids."""
    ordered = sorted({w.encode() for w in words if w})
    states: list[tuple] = []  # (final, ((byte, state), ...))
    register: dict[tuple, int] = {}
    path: list[list] = [[False, []]]  # open states of the last word

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    last = b""
    for word in ordered:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        close(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))
    below, first, labels, target, skip, final = [], [0], bytearray(), [], [], bytearray()
    for end, arcs in states:  # a state follows all that it leads to
        n = int(end)
        for b, to in arcs:
            labels.append(b)
            target.append(to)
            skip.append(n)
            n += below[to]
        below.append(n)
        final.append(end)
        first.append(len(target))
    offsets, ids = [0], []
    for word in ordered:
        ids += ids_of(word.decode())
        offsets.append(len(ids))
    ints = [first, target, skip, offsets, ids]
    head = struct.pack("<8I", root, len(states), len(target), *map(len, ints))
    pad = lambda b: bytes(b) + bytes(-len(b) % 4)
    return head + b"".join(struct.pack(f"<{len(x)}I", *x) for x in ints) + pad(labels) + pad(final)


class Lexicon:
    """A memory-mapped transducer; ids(word) are its little-endian 32-bit ids, None for a word that it doesn't hold."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, n_states, n_arcs, *sizes = struct.unpack_from("<8I", self.map)
        at = 32
        tables = []
        for n in sizes:
            tables.append(np.frombuffer(self.map, "<u4", n, at))
            at += 4 * n
        first, self.target, self.skip, self.offsets, _ = tables
        self.ids_at = at - 4 * sizes[-1]
        labels = np.frombuffer(self.map, np.uint8, n_arcs, at)
        self.final = np.frombuffer(self.map, np.uint8, n_states, at + n_arcs + -n_arcs % 4)
        #: State and byte of each arc as one number; the tables hold arcs in this order.
        self.arcs = np.repeat(np.arange(n_states, dtype=np.int64), np.diff(first)) << 8 | labels

    def ids(self, word: str) -> bytes | None:
        return self.lookup([word])[0]

    def lookup(self, words: list[str]) -> list[bytes | None]:
        """The ids of each word; all words take a step along their bytes at a time."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        starts = np.cumsum(sizes) - sizes
        text = np.frombuffer(b"".join(data) or b"\0", np.uint8)
        state, rank = np.full(len(data), self.root, np.int64), np.zeros(len(data), np.int64)
        ended = np.zeros(len(data), bool)
        on, step = np.arange(len(data)), 0
        while len(on):
            done = sizes[on] == step
            ended[on[done]] = True
            on = on[~done]
            if not len(on) or not len(self.arcs):
                break
            keys = state[on] << 8 | text[starts[on] + step]
            arc = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            known = self.arcs[arc] == keys
            on, arc = on[known], arc[known]
            rank[on] += self.skip[arc]
            state[on] = self.target[arc]
            step += 1
        out: list[bytes | None] = [None] * len(data)
        held = np.flatnonzero(ended & (self.final[state] > 0))
        for i, a, b in zip(held.tolist(), self.offsets[rank[held]].tolist(), self.offsets[rank[held] + 1].tolist(), strict=True):
            out[i] = self.map[self.ids_at + 4 * a : self.ids_at + 4 * b]
        return out


class Codec:
    """word -> ids as bytes in a bounded table, filled from the lexicon or else by exact merges.

    Long words are held for the texts at hand only, so that the table is bounded in bytes.
    """

    def __init__(self, lexicon: Lexicon | None, bpe: WordBpe, most: int = 600_000):
        self.lexicon, self.bpe = lexicon, bpe
        #: A special string's key has a blank before it, which no word has.
        self.special = {" " + s: struct.pack("<I", i) for s, i in bpe.special.items()}
        self.table = WordTable(self._make, most, KEPT_LETTERS, self.special)

    def _make(self, words: list[str]) -> list[bytes]:
        found = self.lexicon.lookup(words) if self.lexicon else [None] * len(words)
        unseen = iter(self.bpe.merge_words([w for w, ids in zip(words, found, strict=True) if ids is None]))
        return [next(unseen) if ids is None else ids for ids in found]

    def fill(self, words: set[str]) -> dict[str, bytes]:
        """The table, with all of ``words`` in it."""
        return self.table.fill(words)

    def words(self, text: str) -> list[str]:
        """The table's keys for a whole text, in order."""
        if self.bpe.cut and "<|" in text:
            split = ([" " + part] if part in self.bpe.special else word_keys(part) for part in self.bpe.cut.split(text))
            return [w for own in split for w in own]
        return word_keys(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers; special strings inside become their own ids."""
        split = [self.words(t) for t in texts]
        held = self.fill(set().union(*split))
        return [b"".join(map(held.__getitem__, own)) for own in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The token strings, separated by blanks: the file names no decoder."""
        return " ".join(map(self.bpe.tokens.__getitem__, memoryview(ids).cast("I")))


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = 65_536) -> list[str]:
    """The most frequent words of LONG_WORD letters or less over all texts, ``most`` at most: all whose count reaches a bound, then some of the level below it.

    The bound comes from a histogram of counts in sixteenths of an octave, so that no more than ``most`` short words ever come to the driver; of the level
    that doesn't fit whole, those that sort first are taken. Longer words are merged like all others that the lexicon lacks.
    """
    counted = word_counts(docs, word_keys, text_col).where(F.length("word") <= LONG_WORD)
    counted = store(counted.select("word", F.floor(F.log2("n") * 16).cast("int").alias("level")), "word-levels")
    total, bound, part = 0, 1 << 30, None
    for r in sorted(counted.groupBy("level").count().collect(), key=lambda r: -r["level"]):  # a thousand levels at most
        if total + r["count"] > most:
            part = r["level"]
            break
        total, bound = total + r["count"], r["level"]
    found = [r["word"] for r in counted.where(F.col("level") >= bound).select("word").collect()]
    if part is not None and total < most:
        found += [r["word"] for r in counted.where(F.col("level") == part).select("word").orderBy("word").limit(most - total).collect()]
    return sorted(found)


def ship_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text", most: int = 65_536) -> str:
    """Compile the lexicon of ``docs``, write it to the shared folder and send it to the executors; returns its file name."""
    spark = docs.sparkSession
    bpe = WordBpe(tokenizer_path)
    data = compile_lexicon(frequent_words(docs, text_col, most), bpe.merge_word)
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.fst"
    system, base = fs.FileSystem.from_uri(shared_dir(spark))
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{name}", compression=None) as f:
        f.write(data)
    spark.sparkContext.addFile(f"{shared_dir(spark)}/{name}")
    return name


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 65_536) -> DataFrame:
    """(id, ids binary, decoded string) for each row: the ids of the whole text and the text decoded from them.

    Null and empty texts have no ids. Repeated rows give repeated results; a null id stays null. Only the id and the text are
    read, whole texts of any length; an empty table gives an empty result.
    """
    name = ship_lexicon(docs, tokenizer_path, text_col, lexicon_words)
    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("codec", name, tokenizer_path), lambda: Codec(Lexicon(SparkFiles.get(name)), WordBpe(tokenizer_path)))
        for batch in parts(batches):  # so that few ids and decoded texts are held at once
            ids = codec.encode_all(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids binary, decoded string").withColumnRenamed("id", id_col)
