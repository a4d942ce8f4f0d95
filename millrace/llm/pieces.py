"""Exact subword encoding and decoding with a SentencePiece BPE model, in vectorised merge rounds.

A text becomes one flat numpy array of symbols cut into words. Every round finds each word's smallest pair
rank by a segmented minimum, merges its leftmost occurrences together, and compacts the arrays, until no
pair remains. Words that repeat within and between batches are encoded once.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from millrace.llm.common import batches

#: A piece may start with the space mark but has none further in, so no merge crosses these words.
SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Words longer than this are merged with a heap: a word that allows one merge a round would need too many rounds.
LONG_WORD = 400
#: Distinct words kept between batches.
CACHE_WORDS = 200_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceModel:
    """Tables of one model; raises ValueError for a model whose rules these rounds don't follow."""

    def __init__(self, proto: bytes):
        import numpy as np
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        rules, kinds = model.normalizer_spec, [p.type for p in model.pieces]
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces or set(kinds) - {1, 2, 3, 6}:
            raise ValueError("only BPE models with byte fallback, no normalization and a space before the text are supported")
        self.n = n = len(kinds)
        self.normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        if any(SPACE in q.lstrip(SPACE) for q in self.normal):
            raise ValueError("a piece holds a space mark inside")
        score = np.array([p.score for p in model.pieces])
        order = np.unique(-score)  # equal scores share a rank
        self.rank = np.append(np.searchsorted(order, -score), 0).astype(np.int32)
        self.none = np.int32(len(order) + 1)
        self.bos, self.eos = (next(i for i, p in enumerate(model.pieces) if p.piece == x) for x in ("<s>", "</s>"))
        self.byte = np.zeros(256, np.int32)
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte[int(p.piece[3:5], 16)] = i
        # Merges: every cut of a piece into two pieces. single: pieces after whose merge a better pair can appear.
        keys, values, single = [], [], np.zeros(n + 1, bool)
        for piece, i in self.normal.items():
            if score[i] < -1e8:
                single[i] = True
            for cut in range(1, len(piece)):
                a, b = self.normal.get(piece[:cut]), self.normal.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    values.append(i)
                    for x in (a, b):
                        single[x] |= score[x] <= score[i]
        self.single, self.merge = single, dict(zip(keys, values, strict=True))
        self._hash(np.array(keys, np.int64), np.array(values, np.int32))
        top = max(map(ord, (q for q in self.normal if len(q) == 1)))
        self.char = np.full(top + 2, -1, np.int32)
        for q, i in self.normal.items():
            if len(q) == 1:
                self.char[ord(q)] = i
        spelled = [p.piece.replace(SPACE, " ").encode() if p.type == 1 else bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b"" if p.type == 3 else " ⁇ ".encode() for p in model.pieces]
        self.spell_len = np.array([len(x) for x in spelled], np.int64)
        self.spell_at = np.concatenate([[0], np.cumsum(self.spell_len)[:-1]])
        self.spell = np.frombuffer(b"".join(spelled), np.uint8)
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.words: dict[str, int] = {}
        self.ids, self.at, self.lens = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _hash(self, keys, values) -> None:
        """Open addressing over a power of two; probes is the longest chain."""
        import numpy as np

        self.bits, mask = 19, (1 << 19) - 1
        table, out, todo, probe = np.full(mask + 1, -1, np.int64), np.full(mask + 1, -1, np.int32), np.arange(len(keys)), 0
        while len(todo):
            slot = (self._slot(keys[todo]) + probe) & mask
            free = table[slot] < 0
            taken, first = np.unique(slot[free], return_index=True)
            won = todo[free][first]
            table[taken], out[taken] = keys[won], values[won]
            todo, probe = todo[~np.isin(todo, won, assume_unique=True)], probe + 1
        self.table, self.out, self.probes = table, out, probe

    def _slot(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left, right):
        """The merged piece for each pair, -1 for none. Symbols from n upwards are characters outside the vocabulary."""
        import numpy as np

        found = np.full(len(left), -1, np.int32)
        where = np.flatnonzero((left < self.n) & (right < self.n))
        keys = left[where].astype(np.int64) << 20 | right[where]
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        for _ in range(self.probes):
            held = self.table[slot]
            hit = held == keys
            found[where[hit]] = self.out[slot[hit]]
            on = ~hit & (held >= 0)
            if not on.any():
                break
            where, keys, slot = where[on], keys[on], (slot[on] + 1) & mask
        return found

    def rounds(self, words: list[str]):
        """(symbols, symbols per word) after all merges of words that each hold a character at least."""
        import numpy as np

        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        n_words = len(words)
        word = np.repeat(np.arange(n_words), [len(w) for w in words])
        ids = self.char[np.minimum(points, len(self.char) - 1)]
        sym = np.where(ids >= 0, ids, self.n + points).astype(np.int32)
        pair = np.full(len(sym), -1, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair[inside] = self.pairs(sym[inside], sym[inside + 1])
        kept_sym, kept_word = [], []
        while len(sym):
            rank = np.where(pair >= 0, self.rank[pair], self.none)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            spread = np.repeat(least, size)
            done = spread == self.none
            if done.any():
                kept_sym.append(sym[done])
                kept_word.append(word[done])
                go = ~done
                sym, pair, word, rank, spread = sym[go], pair[go], word[go], rank[go], spread[go]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == spread)
            # Overlapping occurrences stand side by side: of each run, every other one from its left merges.
            new = np.concatenate([[True], (np.diff(at) > 1) | (word[at][1:] != word[at][:-1])])
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            lead = np.concatenate([[True], word[at][1:] != word[at][:-1]])
            at = at[(place % 2 == 0) & (lead | ~self.single[pair[at]])]
            sym[at] = pair[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = (np.cumsum(keep) - 1)[at]
            sym, pair, word = sym[keep], pair[keep], word[keep]
            near = np.zeros(len(sym) + 1, bool)
            near[now] = near[now - 1] = True
            touched = np.flatnonzero(near[:-1])
            last = touched + 1 >= len(sym)
            pair[touched[last]] = -1
            touched = touched[~last]
            inside = word[touched] == word[touched + 1]
            pair[touched[~inside]] = -1
            touched = touched[inside]
            pair[touched] = self.pairs(sym[touched], sym[touched + 1])
        sym, word = np.concatenate(kept_sym), np.concatenate(kept_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n_words)

    def heap(self, word: str) -> list[int]:
        """The same merges one at a time, for a very long word."""
        sym = [self.normal.get(c, self.n + ord(c)) for c in word]
        left, right = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        ranks = self.rank.tolist()
        todo = [(ranks[m], i, sym[i], sym[i + 1]) for i in range(len(sym) - 1) if (m := self.merge.get(sym[i] << 20 | sym[i + 1] if max(sym[i], sym[i + 1]) < self.n else -1)) is not None]
        heapq.heapify(todo)
        while todo:
            _, i, a, b = heapq.heappop(todo)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = self.merge[a << 20 | b], -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and max(sym[x], sym[y]) < self.n and (m := self.merge.get(sym[x] << 20 | sym[y])) is not None:
                    heapq.heappush(todo, (ranks[m], x, sym[x], sym[y]))
        return [s for s in sym if s >= 0]

    def learn(self, words: list[str]) -> None:
        """Encode words not met before and keep them."""
        import numpy as np

        short, long = [w for w in words if len(w) <= LONG_WORD], [w for w in words if len(w) > LONG_WORD]
        sym, lens = self.rounds(short) if short else (np.empty(0, np.int32), np.empty(0, np.int64))
        for w in long:
            s = self.heap(w)
            sym, lens = np.append(sym, np.array(s, np.int64)), np.append(lens, len(s))
        # Characters outside the vocabulary become their UTF-8 bytes.
        odd = np.flatnonzero(sym >= self.n)
        if len(odd):
            raw = [chr(x).encode() for x in (sym[odd] - self.n).tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(x) for x in raw]
            owner = np.repeat(np.arange(len(lens)), lens)
            lens = np.bincount(owner, weights=times, minlength=len(lens)).astype(np.int64)
            wide = np.repeat(sym >= self.n, times)
            sym = np.repeat(sym, times)
            sym[wide] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        base = len(self.ids)
        self.words.update(zip([*short, *long], range(len(self.at), len(self.at) + len(words)), strict=True))
        self.at = np.concatenate([self.at, base + np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)])
        self.lens, self.ids = np.concatenate([self.lens, lens]), np.concatenate([self.ids, sym.astype(np.int32)])

    def encode(self, texts: list[str]):
        """(flat ids without begin and end, ids per text)."""
        import numpy as np

        if len(self.words) > CACHE_WORDS:
            self.forget()
        cut = [WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        flat = [w for words in cut for w in words]
        fresh = list({w for w in set(flat) if w not in self.words})
        if fresh:
            self.learn(fresh)
        which = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in cut])
        lens = self.lens[which]
        return self.ids[spread(self.at[which], lens)], np.bincount(owner, weights=lens, minlength=len(texts)).astype(np.int64)

    def decode(self, ids) -> bytes:
        """The text of ids as UTF-8; byte pieces that are no UTF-8 become replacement characters."""
        lens = self.spell_len[ids]
        raw = self.spell[spread(self.spell_at[ids], lens)].tobytes()
        raw = raw[1:] if raw[:1] == b" " else raw
        try:
            raw.decode()
        except UnicodeDecodeError:
            # one replacement character for each byte that starts no character
            raw = re.sub(b"[\x80-\xff]+", lambda m: m[0].decode(errors="replace").encode(), raw)
        return raw


def spread(starts, lens):
    """Indexes of the ranges [start, start + len), one after the other."""
    import numpy as np

    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


def digest_rows(model: PieceModel, batch, key: str, text: str) -> dict:
    """The columns of SCHEMA for one Arrow batch."""
    import numpy as np

    ids, counts = model.encode([t or "" for t in batch.column(text).to_pylist()])
    ends, n, a, b = np.cumsum(counts), [], [], []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        own = np.concatenate([[model.bos], ids[end - count : end], [model.eos]]).astype("<u4")
        n.append(len(own))
        a.append(hashlib.sha256(own.tobytes()).hexdigest())
        b.append(hashlib.sha256(model.decode(own)).hexdigest())
    return {"doc_id": batch.column(key), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}


def piece_digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, begin and end ids included.

    Null and empty texts give the two marker ids alone; a null key stays null; repeated rows give equal rows;
    other columns are left out. The model file is read on the driver and travels with the task: its size is
    that of the vocabulary. There is no shuffle, and a lost executor's tasks are simply run again.
    """
    with open(model_path, "rb") as f:
        proto = f.read()

    def run(stream) -> Iterator:
        import pyarrow as pa

        model = PieceModel(proto)
        for batch in batches(stream, 1024, 4_000_000, text):
            yield pa.RecordBatch.from_pydict(digest_rows(model, batch, key, text), schema=pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    from pyspark.sql import functions as F

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, SCHEMA)
