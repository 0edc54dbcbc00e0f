"""Operator 4: byte-level BPE encoding and decoding with a public vocabulary.

Each pre-token is merged with a segment tree over the ranks of its adjacent pairs: the root holds
the lowest rank and its leftmost place, a merge is a few point updates of logarithmic cost, and the
work ends when no pair in the tree can merge. Short pre-tokens are merged many at a time (one numpy row
per pre-token, the same tree), long ones one by one.

Cases: a null text encodes as the empty text (no ids); an empty or null id list decodes to the empty
text; null ids in a list are skipped; very long texts and very long pre-tokens are encoded whole;
repeated rows are encoded each; an empty table gives an empty table; a column already named like an
output column is replaced, all others pass through.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martpulse.llm.common import PerWorker, add_columns, blocks, span_hash

#: Fixed values of the public format: how texts are parted before merging.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_PAIR = 1 << 62
#: Pre-tokens of more bytes are merged one by one.
SHORT = 32
#: Remembered pieces per Python worker; emptied when full.
CACHE_PIECES = 250_000
#: ASCII white space, widely taken.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def byte_of_char() -> dict[str, int]:
    """Vocabulary strings write each byte as one printable character: itself where it is printable in
    Latin-1, else the next free character from U+0100 on."""
    out, free = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(free)] = b
            free += 1
    return out


class Bpe:
    """Codec built from the JSON text of a byte-level BPE tokenizer file."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        vocab, to_byte = doc["model"]["vocab"], byte_of_char()
        special = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: bytes(map(to_byte.__getitem__, t)) for t, i in vocab.items()}
        self.bytes_of.update({i: t.encode() for t, i in special.items()})
        self.special = special
        self.special_re = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.byte_id = [0] * 256
        for char, b in to_byte.items():
            self.byte_id[b] = vocab[char]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(doc["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[left] << 32 | vocab[right], r)
            self.made.append(vocab[left + right])
        self.pre_token = regex.compile(PRE_TOKEN)
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(self.rank.values(), np.int64, len(self.rank))[order]
        self.made_ids = np.array(self.made, np.int64)
        self.byte_ids = np.array(self.byte_id, np.int64)
        self.forget()
        most = max(self.bytes_of, default=0) + 1
        sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(most)], np.int64)
        self.token_at = np.r_[0, np.cumsum(sizes)]
        self.token_data = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(most)), np.uint8)

    def forget(self) -> None:
        """Empty the memory of pieces: hash -> place in ``flat``."""
        self.pieces: dict[bytes, int] = {}
        self.piece_at = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_id[b] for b in raw]
        n = len(ids)
        if n < 2:
            return ids
        rank, made = self.rank, self.made
        size = 1 << (n - 1).bit_length()
        tree = [NO_PAIR] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[size + i] = r << 32 | i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = rank.get
        while True:
            top = tree[1]
            if top == NO_PAIR:
                break
            i = top & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            new = ids[i] = made[top >> 32]
            ids[j] = -1
            after[i] = k
            right = left = NO_PAIR
            if k < n:
                before[k] = i
                r = get(new << 32 | ids[k])
                if r is not None:
                    right = r << 32 | i
            h = before[i]
            if h >= 0:
                r = get(ids[h] << 32 | new)
                if r is not None:
                    left = r << 32 | h
            # point updates: the pair that began at j is gone, those at i and h have new ranks
            for at, value in ((size + j, NO_PAIR), (size + i, right), (size + h, left)) if h >= 0 else (
                    (size + j, NO_PAIR), (size + i, right)):
                if tree[at] != value:
                    tree[at] = value
                    at >>= 1
                    while at:
                        x, y = tree[at + at], tree[at + at + 1]
                        if y < x:
                            x = y
                        if tree[at] == x:
                            break
                        tree[at] = x
                        at >>= 1
        return [x for x in ids if x >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where the two don't merge."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], NO_PAIR >> 8)

    def merge_many(self, raw: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per pre-token) of pre-tokens of 1 to ``size`` bytes (a power of two), joined in ``raw``.

        Row r of ``tree`` is r's segment tree, with the root in column 1 and the pair that begins at
        symbol i in column size + i.
        """
        n = len(lengths)
        row = np.repeat(np.arange(n), lengths)
        col = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        wide = size + 1  # the last column stands for "no symbol"
        ids = np.full(n * wide, -1, np.int64)
        ids[row * wide + col] = self.byte_ids[raw]
        grid = ids.reshape(n, wide)
        rank = self.ranks_of(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(n, size)
        tree = np.full((n, 2 * size), NO_PAIR, np.int64)
        tree[:, size:] = np.where(rank == NO_PAIR >> 8, NO_PAIR, rank << 8 | np.arange(size))
        level = size
        while level > 1:
            level //= 2
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        after = np.tile(np.r_[np.arange(1, wide), size], n)
        after[np.arange(n) * wide + lengths - 1] = size
        before = np.tile(np.r_[size, np.arange(size)], n)
        tree = tree.ravel()
        live = np.arange(n)
        while True:
            top = tree[live * (2 * size) + 1]
            go = top != NO_PAIR
            live, top = live[go], top[go]
            if not len(live):
                break
            base, root = live * wide, live * (2 * size)
            i = top & 255
            j = after[base + i]
            k = after[base + j]
            new = self.made_ids[top >> 8]
            ids[base + i], ids[base + j] = new, -1
            after[base + i] = k
            before[base + k] = i
            h = before[base + i]
            right = self.ranks_of(new, ids[base + k])
            left = self.ranks_of(ids[base + h], new)
            h = np.where(h == size, i, h)  # no symbol on the left: repeat the update at i
            left = np.where(h == i, right, left)
            places = (j, i, h)
            for at, rank in zip(places, (None, right, left), strict=True):
                tree[root + size + at] = NO_PAIR if rank is None else np.where(rank == NO_PAIR >> 8, NO_PAIR, rank << 8 | at)
            level = size
            while level > 1:
                level >>= 1
                places = tuple(at >> 1 for at in places)
                for at in places:
                    node = root + level + at
                    child = root + 2 * (level + at)
                    tree[node] = np.minimum(tree[child], tree[child + 1])
        keep = ids >= 0
        return ids[keep], keep.reshape(n, wide).sum(axis=1)

    def merge_all(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per pre-token) of the pre-tokens at ``starts``."""
        group = np.where(lengths <= SHORT, np.maximum(2, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)), 0)
        parts, sizes, order = [], np.zeros(len(starts), np.int64), []
        for size in np.unique(group).tolist():
            members = np.flatnonzero(group == size)
            for at in range(0, len(members), max(1, (1 << 20) // max(size, 32))):
                m = members[at:at + max(1, (1 << 20) // max(size, 32))]
                if size:
                    ids, sizes[m] = self.merge_many(gather(data, starts[m], lengths[m]), lengths[m], size)
                    parts.append(ids)
                else:
                    got = [self.merge(bytes(data[a:a + k])) for a, k in zip(starts[m].tolist(), lengths[m].tolist(), strict=True)]
                    sizes[m] = list(map(len, got))
                    parts.append(np.array([x for g in got for x in g], np.int64))
                order.append(m)
        if not order:
            return np.zeros(0, np.int64), sizes
        order = np.concatenate(order)
        at = np.zeros(len(sizes), np.int64)
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(np.concatenate(parts), at, sizes), sizes

    def plain_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of texts without added tokens, pre-token by pre-token."""
        cut = list(map(self.pre_token.findall, texts))
        number = {t: i for i, t in enumerate(dict.fromkeys(t for c in cut for t in c))}
        raws = [t.encode() for t in number]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        ids, sizes = self.merge_all(np.frombuffer(b"".join(raws), np.uint8), np.cumsum(lengths) - lengths, lengths)
        which = np.fromiter((number[t] for c in cut for t in c), np.int64)
        owner = np.repeat(np.arange(len(cut)), np.fromiter(map(len, cut), np.int64, len(cut)))
        per_text = np.bincount(owner, weights=sizes[which], minlength=len(cut)).astype(np.int64)
        return gather(ids, (np.cumsum(sizes) - sizes)[which], sizes[which]), per_text

    def encode(self, text: str) -> list[int]:
        """Ids of one text; added tokens found in it are one id each."""
        ids, at = [], 0
        for m in self.special_re.finditer(text) if self.special_re and text else ():
            if m.start() > at:
                ids += self.plain_many([text[at:m.start()]])[0].tolist()
            ids.append(self.special[m.group()])
            at = m.end()
        return ids + (self.plain_many([text[at:]])[0].tolist() if text and at < len(text) else [])

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids per row) of a block of UTF-8 rows.

        Two places always begin a pre-token: a space between two characters that aren't white space, and
        an ASCII character after a letter that is no letter itself. The rows are cut there into pieces;
        equal ones are found by their hash and compared byte by byte, and each distinct one is encoded once
        and remembered by its bytes.
        """
        n, rows = len(data), len(offsets) - 1
        whole = bytes(data)
        odd = np.zeros(rows, bool)  # encoded one by one: added tokens, white space beyond ASCII
        if self.special_re and self.special_re.search(whole.decode()):
            odd |= [bool(self.special_re.search(whole[a:b].decode())) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        wide = np.flatnonzero(data >= 0xC2)
        if len(wide):
            a, b, c = data[wide], data[np.minimum(wide + 1, n - 1)], data[np.minimum(wide + 2, n - 1)]
            blank = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) |
                     (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) |
                     (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80))
            odd[np.searchsorted(offsets, wide[blank], side="right") - 1] = True
        letter = _LETTER[data]  # ASCII and Latin-1, both bytes of the latter
        if len(wide):
            latin = wide[(a == 0xC3) & (b != 0x97) & (b != 0xB7)]
            letter[latin] = letter[latin + 1] = True
        solid = ~_SPACE[data]
        begins = np.zeros(n, bool)
        begins[1:-1] = (data[1:-1] == 32) & solid[:-2] & solid[2:]
        begins[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
        begins[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], n]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        if odd.any():
            plain = ~odd[owner]
            starts, ends, owner = starts[plain], ends[plain], owner[plain]
        _, example, which = np.unique(span_hash(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        other = unlike(data, starts, ends, example[which])
        if other.any():  # pieces that share a hash with other bytes: their rows go one by one
            odd[owner[other]] = True
            plain = ~odd[owner]
            starts, ends, owner = starts[plain], ends[plain], owner[plain]
            _, example, which = np.unique(span_hash(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        place = self.places(whole, data, letter, starts[example], ends[example])[which]
        sizes = self.piece_at[place + 1] - self.piece_at[place]
        out, per_row = gather(self.flat, self.piece_at[place], sizes), np.bincount(owner, weights=sizes, minlength=rows).astype(np.int64)
        if odd.any():
            cut = np.split(out, np.cumsum(per_row)[:-1])
            for r in np.flatnonzero(odd):
                cut[r] = np.array(self.encode(whole[offsets[r]:offsets[r + 1]].decode()), np.int32)
                per_row[r] = len(cut[r])
            out = np.concatenate(cut)
        return out, per_row

    def places(self, whole: bytes, data: np.ndarray, letter: np.ndarray, starts: np.ndarray,
               ends: np.ndarray) -> np.ndarray:
        """Place of each piece in the memory, looked up by its bytes; new ones are encoded first."""
        if len(self.pieces) + len(starts) > CACHE_PIECES:
            self.forget()
        keys = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        place = np.fromiter((self.pieces.get(k, -1) for k in keys), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place
        # letters only, after one space at most: one pre-token; others are cut by the pattern
        count = np.r_[0, np.cumsum(letter)]
        s, e = starts[new], ends[new]
        one = (count[e] - count[s] == e - s - (data[s] == 32)) & (count[e] > count[s])
        new = np.r_[new[one], new[~one]]
        ids, sizes = self.merge_all(data, s[one], (e - s)[one])
        rest_ids, rest_sizes = self.plain_many([bytes(data[a:b]).decode() for a, b in zip(s[~one].tolist(), e[~one].tolist(), strict=True)])
        place[new] = len(self.piece_at) - 1 + np.arange(len(new))
        self.pieces.update(zip([keys[i] for i in new.tolist()], place[new].tolist(), strict=True))
        self.piece_at = np.r_[self.piece_at, self.piece_at[-1] + np.cumsum(np.r_[sizes, rest_sizes])]
        self.flat = np.r_[self.flat, ids.astype(np.int32), rest_ids.astype(np.int32)]
        return place

    def decode(self, ids: list[int]) -> str:
        """Bytes of the ids in order, as UTF-8 (malformed sequences: U+FFFD). An id outside the
        vocabulary adds nothing."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")

    def decode_block(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """As ``decode``, for the rows that ``offsets`` part."""
        ids = np.where((ids >= 0) & (ids < len(self.token_at) - 1), ids, len(self.token_at) - 1)
        sizes = np.r_[np.diff(self.token_at), 0][ids]
        raw = gather(self.token_data, self.token_at[ids], sizes).tobytes()
        ends = np.r_[0, np.cumsum(sizes)][offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def unlike(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, example: np.ndarray) -> np.ndarray:
    """Which spans differ from the span at the place ``example`` names."""
    sizes = ends - starts
    out = sizes != sizes[example]
    look = np.flatnonzero(~out & (example != np.arange(len(starts))))
    wrong = gather(data, starts[look], sizes[look]) != gather(data, starts[example[look]], sizes[look])
    if wrong.any():
        out[look[np.searchsorted(np.cumsum(sizes[look]), np.flatnonzero(wrong), side="right")]] = True
    return out


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[s:s+n] for each start and size, joined."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class BpeTokenizer:
    """Encodes and decodes columns. The vocabulary file (about 2 MB) is read once on the driver and
    broadcast, so executors need no copy of the file."""

    def __init__(self, spark, vocabulary_path: str):
        with open(vocabulary_path, encoding="utf-8") as f:
            self.codec = PerWorker(spark, f.read(), Bpe)

    def encode(self, df: DataFrame, text: str = "text", ids: str = "token_ids", decoded: str | None = None,
               exact: str | None = None) -> DataFrame:
        """``df`` plus the id lists ``ids``; in the same pass, with ``decoded`` what those ids decode to, and with
        ``exact`` whether that is the text again."""
        shared = self.codec

        def run(texts: pa.Array) -> list[pa.Array]:
            codec = shared.get()
            flat, off, back, same = [], [np.zeros(1, np.int64)], [], []
            for _, _, data, offsets in blocks(texts):
                got, per_row = codec.encode_block(data, offsets)
                flat.append(got)
                off.append(off[-1][-1] + np.cumsum(per_row))
                if decoded or exact:
                    texts_again = codec.decode_block(got, np.r_[0, np.cumsum(per_row)])
                    if exact:
                        whole, ends = bytes(data), offsets.tolist()
                        same += [t.encode() == whole[a:b] for t, a, b in zip(texts_again, ends[:-1], ends[1:], strict=True)]
                    if decoded:
                        back += texts_again
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(off).astype(np.int32)), pa.array(np.concatenate(flat)))
            return [lists] + ([pa.array(back, pa.string())] if decoded else []) + ([pa.array(same, pa.bool_())] if exact else [])

        return add_columns(df, text, run, f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
                           + (f", `{exact}` boolean" if exact else ""))

    def decode(self, df: DataFrame, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
        shared = self.codec

        def run(lists: pa.Array) -> list[pa.Array]:
            lists = lists.fill_null([]) if lists.null_count else lists
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            return [pa.array(shared.get().decode_block(flat, np.r_[0, np.cumsum(sizes)]), pa.string())]

        return add_columns(df, ids, run, f"`{text}` string")
