"""Byte-level BPE of a whole corpus with a public tokenizer."""

from __future__ import annotations

import heapq
import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = os.environ.get("LINKSPAN_TOKENIZERS", "/opt/tokenizers")
#: How byte-level BPE cuts text into words before merging (public pattern of the 50k vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text whose words are replayed together, and most words whose ids a worker remembers.
BLOCK_CHARS = 16_000_000
REMEMBERED = 2_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Merges:
    """The merges of a vocabulary file: pair of ids -> (rank, merged id)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.byte_ids = [vocab[x] for x in byte_letters()]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.table = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of every word, by applying each merge in rank order to all words at once.

        The words lie one after the other in an array of symbols linked to their neighbours. An inverted
        index leads from a merge's rank to the positions where its pair stands. Ranks are taken in ascending
        order; at each position the pair is merged if it still stands there, and only the two pairs that the
        merged symbol forms with its neighbours enter the index. A merge forms only pairs of later rank, so no rank
        comes back. Positions of a rank are taken from left to right, as overlapping pairs require.
        """
        table, byte_ids = self.table, self.byte_ids
        symbols: list[int] = []
        starts = []
        for w in words:
            starts.append(len(symbols))
            symbols.extend([byte_ids[b] for b in w])
            symbols.append(-1)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        pairs: dict[int, tuple[int, int, int]] = {}
        get = table.get
        for i in range(n - 1):
            found = get((symbols[i], symbols[i + 1]))
            if found is not None:
                rank = found[0]
                if rank in index:
                    index[rank].append(i)
                else:
                    index[rank] = [i]
                    pairs[rank] = (symbols[i], symbols[i + 1], found[1])
        ranks = list(index)
        heapq.heapify(ranks)
        while ranks:
            rank = heapq.heappop(ranks)
            a, b, merged = pairs[rank]
            positions = index.pop(rank)
            positions.sort()
            for i in positions:
                if symbols[i] != a:
                    continue
                j = after[i]
                if j >= n or symbols[j] != b:
                    continue
                symbols[i] = merged
                symbols[j] = -2
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    right = symbols[k]
                    if right >= 0 and (found := get((merged, right))) is not None:
                        r = found[0]
                        if r in index:
                            index[r].append(i)
                        else:
                            index[r] = [i]
                            pairs[r] = (merged, right, found[1])
                            heapq.heappush(ranks, r)
                h = before[i]
                if h >= 0:
                    left = symbols[h]
                    if left >= 0 and (found := get((left, merged))) is not None:
                        r = found[0]
                        if r in index:
                            index[r].append(h)
                        else:
                            index[r] = [h]
                            pairs[r] = (left, merged, found[1])
                            heapq.heappush(ranks, r)
        out = []
        for s, w in zip(starts, words):
            out.append([x for x in symbols[s : s + len(w)] if x >= 0])
        return out


_LOADED: dict[str, Merges] = {}


def _merges(path: str) -> Merges:
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


class Encoder:
    """Encodes blocks of texts; ids of words met before are remembered up to a fixed number of words."""

    def __init__(self, path: str) -> None:
        import regex

        self.split = regex.compile(PATTERN).findall
        self.merges = _merges(path)
        self.known: dict[str, list[int]] = {}

    def learn(self, cut: list[list[str]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        words: set[str] = set()
        for x in cut:
            words.update(x)
        new = [w for w in words if w not in self.known]
        # Lone surrogates can't come from a Spark string; were there any, they'd be encoded as '?'.
        for w, ids in zip(new, self.merges.replay([w.encode("utf-8", "replace") for w in new])):
            self.known[w] = ids

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.split(t) if t else [] for t in texts]
        self.learn(cut)
        known = self.known
        return [[i for w in x for i in known[w]] for x in cut]

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self.split(t) if t else [] for t in texts]
        self.learn(cut)
        known = self.known
        return [sum([len(known[w]) for w in x]) for x in cut]


def _blocks(batches, key: str, text: str):
    """Arrow batches put together to blocks of about BLOCK_CHARS bytes of text."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(text).nbytes
        if size >= BLOCK_CHARS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _run(path: str, key: str, text: str, out: str, counts: bool):
    def run(batches):
        encoder = None
        for block in _blocks(batches, key, text):
            encoder = encoder or Encoder(path)
            texts = block.column(text).to_pylist()
            if counts:
                values = pa.array(encoder.count(texts), pa.int64())
            else:
                values = pa.array(encoder.encode(texts), pa.list_(pa.int32()))
            done = pa.table({key: block.column(key), out: values})
            yield from done.to_batches(max_chunksize=2000)

    return run


def _apply(df: DataFrame, key: str, text: str, out: str, kind: str, path: str | None, counts: bool) -> DataFrame:
    path = path or f"{TOKENIZERS}/byte_bpe_50k.json"
    rows = df.select(F.col(key), F.col(text))
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, `{out}` {kind}"
    return rows.mapInArrow(_run(path, key, text, out, counts), schema)


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): the ids of each text by a byte-level BPE vocabulary, without special tokens.

    Merges never cross a word, so the replay of all merges over the corpus may run over any part of its
    words: each task cuts its texts into words, replays the merges over the distinct words of a block at once
    and puts the ids back in place. Nothing is shuffled and memory is bounded by the block, so cost grows
    with the corpus alone; a very long text makes one larger block. Rows keep their number: a key that
    occurs twice comes out twice.

    Null and empty texts give an empty list; blank ones are encoded as they stand; the strings of special
    tokens are ordinary text. path is the vocabulary file (byte_bpe_50k.json of the public tokenizers).
    """
    return _apply(df, key, text, "ids", "array<int>", path, False)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens): number of ids that encode_corpus gives each text; 0 for null and empty ones."""
    return _apply(df, key, text, "n_tokens", "bigint", path, True)
