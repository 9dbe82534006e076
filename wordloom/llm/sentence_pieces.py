"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

All texts of a run become one flat NumPy array of symbols. No piece holds a space after another
character, and a character outside the vocabulary joins nothing, so the array falls into words
that cannot affect one another; equal words are encoded once. A round looks up the rank of every
pair of neighbours, takes the least rank of each word, merges its occurrences from the left, and
closes the gaps; words without a pair leave. The rounds end when none is left.

All occurrences of a pair may merge at once if no merge of the result with anything ranks before
it; where the vocabulary has such a merge, only the leftmost occurrence does, as the order then
matters. Runs of spaces rank last and all alike: their merges from the left have a closed form.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.bytewise import U64, byte_view, lean, mix, runs

SPACE = 0x2581
NEVER = np.int32(2**31 - 1)
LONG_WORD = 64
LONG_TEXT = 4 << 20
#: Odd, so that it has an inverse modulo 2^64.
BASE = 0xD1342543DE82EF95


@dataclass(frozen=True)
class Pieces:
    """A BPE vocabulary with byte fallback, as arrays. Symbols are piece ids; -1 is no symbol."""

    ids_of_chars: np.ndarray  # piece id of each code point, -1 if it has none
    pair_keys: np.ndarray  # left * size + right, sorted
    pair_merged: np.ndarray
    pair_ranks: np.ndarray
    unsafe: np.ndarray  # by piece id: a merge with it may rank before it
    bigrams: np.ndarray  # (a << 21 | b) of neighbouring characters of pieces, sorted
    space_runs: dict[int, int]  # number of spaces: piece id
    byte_ids: np.ndarray
    bytes: np.ndarray  # of all pieces as text, one after the other
    byte_ends: np.ndarray
    begin: int
    end: int

    @property
    def size(self) -> int:
        return len(self.byte_ends) - 1


def read_pieces(path: str) -> Pieces:
    """The vocabulary of a model file: BPE, no normalisation, a space put before the text."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or rules.name != "identity":
        raise ValueError("the model is not BPE over text as it is")
    if not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("the model treats spaces in another way")
    space = chr(SPACE)
    scores = {p.piece: (k, -p.score) for k, p in enumerate(model.pieces) if p.type == 1}
    spaces = {len(p): scores[p][0] for p in scores if p == space * len(p) and len(p) > 1}
    if any(space in p.lstrip(space) for p in scores):
        raise ValueError("a piece has a space after another character")
    if any(p.startswith(space * 2) and p != space * len(p) for p in scores):
        raise ValueError("a piece has several spaces before a word")
    chars = np.full(0x110000, -1, np.int32)
    for p, (k, _) in scores.items():
        if len(p) == 1:
            chars[ord(p)] = k
    size = len(model.pieces)
    unsafe = np.zeros(size, bool)
    pairs, bigrams = [], set()
    by_score = sorted((s, k) for p, (k, s) in scores.items() if len(p) > 1)
    rank_of = {k: r for r, (_, k) in enumerate(by_score)}
    for p, (k, _) in scores.items():
        if len(p) < 2 or len(p) in spaces and p[1] == space:
            continue
        bigrams.update(ord(a) << 21 | ord(b) for a, b in zip(p, p[1:]))
        for cut in range(1, len(p)):
            halves = p[:cut], p[cut:]
            if all(h in scores for h in halves):
                left, right = (scores[h][0] for h in halves)
                pairs.append((left * size + right, k, rank_of[k]))
                for half in (left, right):
                    if rank_of.get(half, -1) > rank_of[k]:
                        unsafe[half] = True
    keys, merged, ranks = (np.array(column) for column in zip(*sorted(pairs)))
    shown = [
        bytes([int(p.piece[3:5], 16)]) if p.type == 6
        else b"" if p.type == 3
        else " ⁇ ".encode() if p.type == 2
        else p.piece.replace(space, " ").encode()
        for p in model.pieces
    ]
    byte_ids = np.zeros(256, np.int32)
    for k, p in enumerate(model.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[3:5], 16)] = k
    special = {p.piece: k for k, p in enumerate(model.pieces) if p.type == 3}
    return Pieces(
        chars,
        keys,
        merged.astype(np.int32),
        ranks.astype(np.int32),
        unsafe,
        np.array(sorted(bigrams)),
        spaces,
        byte_ids,
        np.frombuffer(b"".join(shown), np.uint8),
        np.concatenate([[0], np.cumsum([len(s) for s in shown])]),
        special["<s>"],
        special["</s>"],
    )


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + sizes[i] - 1 for each i in turn."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _cut_after(data: np.ndarray, place: int) -> int:
    """The first place from `place` on before a space after something else, or the end."""
    step = 1 << 16
    for a in range(max(place, 3), len(data), step):
        part = data[a - 3 : a + step]
        marked = (part[:-3] == 0xE2) & (part[1:-2] == 0x96) & (part[2:-1] == 0x81)
        found = np.flatnonzero((part[3:] == 32) & (part[2:-1] != 32) & ~marked)
        if len(found):
            return a + int(found[0])
    return len(data)


def _space_run(count: int, sizes: dict[int, int], one: int) -> list[int]:
    """Pieces of `count` spaces: the leftmost piece grows by the next one while it can."""
    out: list[int] = []
    for _ in range(count):
        out.append(1)
        # A new space joins the last piece, and a grown last piece may join the one before.
        while len(out) > 1 and out[-2] + out[-1] in sizes:
            out[-2:] = [out[-2] + out[-1]]
    return [one if n == 1 else sizes[n] for n in out]


class Encoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.up = self.down = np.ones(1, U64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, NEVER if it is no piece."""
        keys = left.astype(np.int64) * self.p.size + right
        at = np.minimum(np.searchsorted(self.p.pair_keys, keys), len(self.p.pair_keys) - 1)
        found = (self.p.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.p.pair_ranks[at], NEVER)

    def _merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over words given one after the other; their symbols and sizes at the end."""
        p = self.p
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word = np.arange(len(sizes))  # the numbers of the words still in work
        rank = np.full(len(symbols), NEVER)
        rank[:-1] = self._ranks(symbols[:-1], symbols[1:])
        rank[np.cumsum(sizes) - 1] = NEVER
        while len(word):
            first = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, first)
            over = least == NEVER
            if over.any():
                mine = np.repeat(over, sizes)
                done.append((word[over], symbols[mine], sizes[over]))
                symbols, rank = symbols[~mine], rank[~mine]
                word, sizes, least = word[~over], sizes[~over], least[~over]
                if not len(word):
                    break
                first = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(word)), sizes)
            hits = np.flatnonzero(rank == least[owner])
            # Of hits that overlap, every other one from the left.
            fresh = np.ones(len(hits), bool)
            fresh[1:] = hits[1:] != hits[:-1] + 1
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - begin) % 2 == 0]
            keys = symbols[hits].astype(np.int64) * p.size + symbols[hits + 1]
            merged = p.pair_merged[np.searchsorted(p.pair_keys, keys)]
            lead = np.ones(len(hits), bool)
            lead[1:] = owner[hits[1:]] != owner[hits[:-1]]
            take = lead | ~p.unsafe[merged]
            hits, merged = hits[take], merged[take]
            symbols[hits] = merged
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            sizes = sizes - np.bincount(owner[hits], minlength=len(word))
            place = np.cumsum(keep) - 1
            symbols, rank = symbols[keep], rank[keep]
            at = place[hits]
            last = np.cumsum(sizes) - 1
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            inner = changed[changed < len(symbols) - 1]
            rank[inner] = self._ranks(symbols[inner], symbols[inner + 1])
            rank[last] = NEVER
        words = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        flat = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int32)
        counts = np.concatenate([d[2] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(words, kind="stable")
        starts = np.cumsum(counts) - counts
        return flat[_spread(starts[order], counts[order])], counts[order]

    def _hashes(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(symbols):
            steps = np.full(len(symbols) + 1, U64(BASE))
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=U64)
            steps[1:] = U64(pow(BASE, -1, 1 << 64))
            self.down = np.cumprod(steps, dtype=U64)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(symbols) + 1, U64)
            np.cumsum(mix(symbols.astype(U64) + U64(1)) * self.up[: len(symbols)], out=sums[1:])
            raw = (sums[starts + sizes] - sums[starts]) * self.down[starts]
            return mix(raw + sizes.astype(U64) * U64(0xD6E8FEB86659FD93))

    def _encode_words(self, chars, starts, sizes):
        """Ids of distinct words: flat ids and sizes."""
        p = self.p
        points = chars[_spread(starts, sizes)]
        symbols = p.ids_of_chars[points]
        unknown = symbols < 0  # each is a word of its own
        flat, counts = self._merge(symbols.copy(), sizes)
        one = p.ids_of_chars[SPACE]
        first = np.cumsum(counts) - counts
        # Replace runs of spaces, and characters outside the vocabulary by their bytes.
        odd = np.zeros(len(counts), bool)
        two = counts > 1
        odd[two] = (flat[first[two]] == one) & (flat[first[two] + 1] == one)
        odd |= np.maximum.reduceat(unknown, np.cumsum(sizes) - sizes) if len(sizes) else False
        if not odd.any():
            return flat, counts
        parts, lengths = [], counts.copy()
        ends = first + counts
        point_starts = np.cumsum(sizes) - sizes
        at = 0
        for w in np.flatnonzero(odd):
            parts.append(flat[at : first[w]])
            own = flat[first[w] : ends[w]]
            if unknown[point_starts[w]]:
                new = p.byte_ids[list(chr(points[point_starts[w]]).encode())]
            else:
                n = int(np.argmax(own != one)) if (own != one).any() else len(own)
                new = np.concatenate([_space_run(n, p.space_runs, one), own[n:]]).astype(np.int32)
            parts.append(new)
            lengths[w] = len(new)
            at = ends[w]
        parts.append(flat[at:])
        return np.concatenate(parts), lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts one after the other, without begin and end, and how many each has.

        A text that is long by itself is encoded part by part, cut before spaces.
        """
        if len(offsets) == 2 and len(data) > LONG_TEXT:
            parts, a = [], 0
            while a < len(data):
                b = _cut_after(data, a + LONG_TEXT)
                parts.append(self._encode(data[a:b], np.array([0, b - a]), a == 0)[0])
                a = b
            return np.concatenate(parts), np.array([sum(map(len, parts))])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray, lead: bool = True):
        """`lead`: a space goes before each text."""
        p = self.p
        n = len(offsets) - 1
        leading = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = leading[offsets]
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        # A space goes before each text that is not empty.
        some = np.flatnonzero(np.diff(ends) > 0)
        chars = (np.insert(chars, ends[some], ord(" ")) if lead else chars).astype(np.int64)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        begins = ends[some] + np.arange(len(some)) * lead
        chars[chars == ord(" ")] = SPACE
        blank = chars == SPACE
        known = p.ids_of_chars[chars] >= 0
        cut = ~known
        cut[1:] |= ~known[:-1]
        cut[1:] |= blank[1:] & ~blank[:-1]
        cut[begins] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(chars)))
        if (sizes > LONG_WORD).any():
            # Cut long words where no piece holds the two neighbours.
            inside = _spread(starts[sizes > LONG_WORD], sizes[sizes > LONG_WORD])
            inside = inside[~cut[inside]]
            keys = chars[inside - 1] << 21 | chars[inside]
            at = np.minimum(np.searchsorted(p.bigrams, keys), len(p.bigrams) - 1)
            apart = (p.bigrams[at] != keys) & ~(blank[inside] & blank[inside - 1])
            cut[inside[apart]] = True
            starts = np.flatnonzero(cut)
            sizes = np.diff(np.append(starts, len(chars)))
        _, example, which = np.unique(
            self._hashes(chars, starts, sizes), return_index=True, return_inverse=True
        )
        flat, counts = self._encode_words(chars, starts[example], sizes[example])
        first = np.cumsum(counts) - counts
        ids = flat[_spread(first[which], counts[which])]
        text = np.searchsorted(begins, starts, "right") - 1
        per_text = np.zeros(n, np.int64)
        per_text[some] = np.bincount(text, counts[which], minlength=len(some)).astype(np.int64)
        return ids, per_text

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of ids given one after the other, and the offset of each text.

        The space that encoding put before a text goes. Ids of single bytes give those bytes.
        """
        p = self.p
        size = np.diff(p.byte_ends)[ids]
        blocks = [
            p.bytes[_spread(p.byte_ends[:-1][ids[a : a + LONG_TEXT]], size[a : a + LONG_TEXT])]
            for a in range(0, len(ids), LONG_TEXT)
        ]
        data = np.concatenate([np.zeros(0, np.uint8), *blocks])
        ends = np.concatenate([[0], np.cumsum(size)])
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        some = np.flatnonzero(np.diff(offsets) > 0)
        lead = offsets[some][data[offsets[some]] == 32]
        gone = np.zeros(len(data) + 1, np.int64)
        gone[lead + 1] = 1
        keep = np.ones(len(data), bool)
        keep[lead] = False
        return data[keep], offsets - np.cumsum(gone)[offsets]


def _sent(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(read_pieces(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for rows (doc_id, text): token ids as array<int>, begin and end included.

    A null or empty text has begin and end only. One row per row; extra columns are ignored.
    """
    pieces = _sent(docs.sparkSession, path)

    def run(batches):
        encoder = Encoder(pieces.value)
        p = pieces.value
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            for i, j in runs(offsets):
                part = data[offsets[i] : offsets[j]]
                ids, counts = encoder.encode(part, offsets[i : j + 1] - offsets[i])
                ends = np.concatenate([[0], np.cumsum(counts)])
                whole = np.insert(ids, ends[:-1], p.begin)
                whole = np.insert(whole, ends[1:] + np.arange(1, j - i + 1), p.end).astype(np.int32)
                places = pa.array((ends + 2 * np.arange(j - i + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.ListArray.from_arrays(places, pa.array(whole))],
                    ["doc_id", "ids"],
                )

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) for rows (doc_id, ids); null or no ids give an empty text."""
    pieces = _sent(rows.sparkSession, path)

    def run(batches):
        encoder = Encoder(pieces.value)
        for batch in batches:
            column = batch.column("ids")
            ids = column.flatten().to_numpy()
            counts = np.diff(column.offsets.to_numpy())
            data, offsets = encoder.decode(ids, counts)
            texts = [
                data[a:b].tobytes().decode(errors="replace") for a, b in zip(offsets, offsets[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), column, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    rows = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"doc_id {kind}, ids array<int>, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded and decoded within one task, so
    that neither ids nor decoded texts leave it. Nulls and repeats as in `encode`."""
    pieces = _sent(docs.sparkSession, path)

    def run(batches):
        encoder = Encoder(pieces.value)
        begin, end = (
            np.array([x], "<u4").tobytes() for x in (pieces.value.begin, pieces.value.end)
        )
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            for i, j in runs(offsets):
                part = data[offsets[i] : offsets[j]]
                ids, counts = encoder.encode(part, offsets[i : j + 1] - offsets[i])
                decoded, places = encoder.decode(ids, counts)
                raw, shown = memoryview(ids.astype("<u4").tobytes()), memoryview(decoded.tobytes())
                ends = 4 * np.concatenate([[0], np.cumsum(counts)])
                hashed = []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    h = hashlib.sha256(begin)
                    h.update(raw[a:b])
                    h.update(end)
                    hashed.append(h.hexdigest())
                back = [
                    hashlib.sha256(shown[a:b]).hexdigest()
                    for a, b in zip(places[:-1].tolist(), places[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(counts + 2),
                        pa.array(hashed, pa.string()),
                        pa.array(back, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
