"""BPE encoding and decoding with a pair occurrence index.

A task takes the different words of a stretch of its texts, lays their symbols out in
one array with links to the next and previous symbol, and indexes which positions hold
which mergeable pair. The ranks of the pairs that occur are applied in ascending order;
each merge rewrites all positions of its pair at once and files the pairs it creates
under their own ranks. Words are independent of each other, so the order of ranks within
each word is the one that merging word by word would follow.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import gathered, map_batches

BATCH_CHARS = 12 << 20  # text whose different words share one index

# The Unicode white space characters, as the tokenizer's \s has them.
_SPACE = "\t-\r \x85\xa0  -     　"
_WORDS = re.compile(f"[^{_SPACE}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split() only


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the letters from U+0100.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class PairIndexBpe:
    """Merges of a byte-level vocabulary, applied to many words at once."""

    def __init__(self, model: dict) -> None:
        self.vocab: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([self.vocab[a] for a in letters], np.int32)
        self.final = np.array([self.vocab[a + suffix] for a in letters], np.int32)
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([self.vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([self.vocab[a + b] for a, b in merges], np.int32)
        self.width = max(self.vocab.values()) + 1
        keys = self.left * self.width + self.right
        order = np.argsort(keys, kind="stable")
        first = np.concatenate(([True], np.diff(keys[order]) != 0)) if len(keys) else []
        self.keys = np.append(keys[order][first], np.iinfo(np.int64).max)
        self.rank = np.append(order[first], -1).astype(np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], -1)

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and where each word starts (and ends)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        joined = np.frombuffer(b"".join(words), np.uint8)
        last = ends[sizes > 0] - 1
        symbol = self.inner[joined]
        symbol[last] = self.final[joined[last]]
        after = np.arange(1, len(joined) + 1, dtype=np.int32)
        before = np.arange(-1, len(joined) - 1, dtype=np.int32)
        after[last] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        alive = np.ones(len(joined), bool)
        self._merge(symbol, after, before, alive)
        kept = np.concatenate(([0], np.cumsum(alive)))
        return symbol[alive], kept[np.concatenate(([0], ends))]

    def _merge(
        self, symbol: np.ndarray, after: np.ndarray, before: np.ndarray, alive: np.ndarray
    ) -> None:
        occurrences: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(at: np.ndarray) -> None:
            """File positions under the rank of the pair that starts there."""
            ranks = self._ranks(symbol[at], symbol[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(
                ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True
            ):
                if rank not in occurrences:
                    occurrences[rank] = []
                    heapq.heappush(active, rank)
                occurrences[rank].append(part)

        index(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            parts = occurrences.pop(rank)
            left, right = self.left[rank], self.right[rank]
            at = np.concatenate(parts) if len(parts) > 1 else parts[0]
            if left == right:
                at = np.unique(at)
            then = after[at]
            holds = alive[at] & (symbol[at] == left) & (then >= 0)
            holds &= symbol[then] == right
            at, then = at[holds], then[holds]
            if left == right and len(at) > 1:  # of a run like aaaa, every other pair
                chained = np.concatenate(([False], then[:-1] == at[1:]))
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(chained, 0, place))
                at, then = at[(place - run) % 2 == 0], then[(place - run) % 2 == 0]
            if not len(at):
                continue
            symbol[at] = self.merged[rank]
            alive[then] = False
            beyond = after[then]
            after[at] = beyond
            before[beyond[beyond >= 0]] = at[beyond >= 0]
            changed = np.concatenate((at[beyond >= 0], before[at][before[at] >= 0]))
            index(changed)


class WordTokenizer:
    """A vocabulary file of words in lower case: whole texts to ids and back.

    The text is composed (NFC) and lower-cased, cut at white space and by the file's
    pattern, spelled in byte letters and merged. Special tokens are cut out first, as
    they are written.
    """

    def __init__(self, spec: str) -> None:
        file = json.loads(spec)
        self.bpe = PairIndexBpe(file["model"])
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tokens = {i: t for t, i in (self.bpe.vocab | self.special).items()}

    def words(self, text: str) -> list[str]:
        return text.split() if not _ODD_SPACE.search(text) else _WORDS.findall(text)

    def _pieces(self, word: str) -> list[bytes | int]:
        """The pieces of a word in UTF-8, and the ids of special tokens."""
        if word.isascii() and word.isalpha():
            return [word.lower().encode()]
        found: list[bytes | int] = []
        for part in self.cut.split(word) if "<|" in word else [word]:
            if part in self.special:
                found.append(self.special[part])
                continue
            part = unicodedata.normalize("NFC", part)
            # Letter by letter: str.lower() treats a final sigma by its context.
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            found += [piece.encode() for piece in self.pieces(part)]
        return found

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """The ids of each word. Contractions such as 's are cut per word, not across."""
        cut = [self._pieces(w) for w in words]
        ids, starts = self.bpe.encode([p for w in cut for p in w if isinstance(p, bytes)])
        ids, starts = ids.tolist(), starts.tolist()
        out, n = [], 0
        for pieces in cut:
            own: list[int] = []
            for piece in pieces:
                if isinstance(piece, bytes):
                    own += ids[starts[n] : starts[n + 1]]
                    n += 1
                else:
                    own.append(piece)
            out.append(own)
        return out

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def encode_decode(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    with_decoded: bool = True,
) -> DataFrame:
    """One row (key, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) per row.

    ``ids`` are those of the whole text, without a start or end token; ``decoded`` is what
    they decode to, special tokens kept. The digests are over the decimal ids joined by
    one space and over the decoded text. A null or blank text has no ids and decodes to
    the empty text. Repeated rows are encoded each; other columns are left out, whatever
    their names; an empty table gives no rows. ``with_ids`` and ``with_decoded`` leave out
    the large column that they name if false.

    A task holds about 12 MB of text, its different words, and at least one whole text.
    The vocabulary file is read once, by the driver.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(spec)
        spell = tokenizer.tokens
        for batch in gathered(batches, "_text", BATCH_CHARS):
            texts = [tokenizer.words(t or "") for t in batch.column("_text").to_pylist()]
            words = list({w for t in texts for w in t})
            ids = tokenizer.encode_words(words)
            number = dict(zip(words, range(len(words)), strict=True))
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            # A word without ids leaves no gap between its neighbours.
            digits = [" ".join(map(str, i)) for i in ids]
            letters = [" ".join([spell[i] for i in w]) for w in ids]
            gaps = any(not i for i in ids)
            sizes, id_hashes, text_hashes, decoded = [], [], [], []
            store = np.fromiter((i for w in ids for i in w), np.int32, int(counts.sum()))
            starts = np.cumsum(counts) - counts
            flat = []
            for t in texts:
                at = [number[w] for w in t]
                if gaps:
                    at = [n for n in at if ids[n]]
                spelled = " ".join([letters[n] for n in at])
                sizes.append(int(counts[at].sum()) if at else 0)
                written = " ".join([digits[n] for n in at])
                id_hashes.append(hashlib.sha256(written.encode()).hexdigest())
                text_hashes.append(hashlib.sha256(spelled.encode()).hexdigest())
                if with_ids:
                    order = np.array(at, np.int64)
                    own, ends = counts[order], np.cumsum(counts[order])
                    source = np.repeat(starts[order] - (ends - own), own)
                    flat.append(store[source + np.arange(len(source))])
                if with_decoded:
                    decoded.append(spelled)
            columns = [
                batch.column("_key"),
                pa.array(sizes, pa.int64()),
                pa.array(id_hashes, pa.string()),
                pa.array(text_hashes, pa.string()),
            ]
            if with_ids:
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(flat))))
            if with_decoded:
                columns.append(pa.array(decoded, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    names = ["_key", "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = (
        f"_key {dict(kept.dtypes)['_key']}, n_tokens bigint, ids_sha256 string, "
        "decoded_sha256 string"
    )
    if with_ids:
        names.append("ids")
        schema += ", ids array<int>"
    if with_decoded:
        names.append("decoded")
        schema += ", decoded string"
    return map_batches(kept, work, schema).withColumnRenamed("_key", key)
