"""Cross-tokenizer alignment: divide and conquer at byte offsets where both tokenizers end a token.

An interval of a text is cut at the common end nearest to its middle, which bisecting the other
tokenizer's ends finds; both halves go on, and intervals without a cut are the leaf groups.  All
intervals of a slice of rows advance together, a level at a time, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices, written

#: Byte-level BPE (A) and BPE with word pieces (B); the files are at the same paths on every executor.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct units (words, mostly) whose tokens a worker remembers between slices; beyond it the frequent ones stay.
STORE_MOST = 200_000
#: Units that A encodes as one text.
_JOINED = 32
#: Bytes of text whose tokens a task holds at once (a whole text at least).
SLICE_BYTES = 1 << 20
#: A pair of token ids as one number: A's id above these bits, B's below.
_B_BITS = 20


class Pair:
    """Both tokenizers, the bytes of their tokens, and the strings of their ids."""

    def __init__(self, byte_level: str, pieces: str):
        import json
        import os

        import numpy as np
        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        vocabulary = self.a.get_vocab(with_added_tokens=True) | vocabulary
        # byte-level alphabet: printable characters stand for themselves, the other bytes follow from U+0100 on
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in same]
        byte_of = {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(other)}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry)
        is_byte = regex.compile(r"<0x([0-9A-F]{2})>").fullmatch
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            found = is_byte(piece)
            self.b_bytes.append(bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # ids with what follows them: A inside a group, A at its end, B inside a group, B at its end
        names = [f"{i}{after}".encode() for count, afters in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for after in afters for i in range(count)]
        self.names = np.array(names, object)
        # One space between two characters that aren't white space: A's pattern always splits before it.  B's merges
        # can't cross it as long as none of its pieces has a space after another character.
        joins = any(regex.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.cut = None if joins else regex.compile(r"(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")
        self.beside_cut = frozenset(map(chr, (*range(0x21, 0x7F), *range(0xC0, 0x250))))
        self.forget()

    def forget(self) -> None:
        """Starts the store of units anew."""
        import numpy as np

        self.known: dict[str, int] = {}  # numbered in the order of entry
        self.seen = np.zeros(0, np.int64)  # occurrences of each unit, halved whenever units are dropped
        self.stored = [np.zeros(0, np.int32), np.zeros(0, np.int32)]  # ids of A and B, unit after unit
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.exact = np.zeros(0, bool)  # whether both sides give back the unit

    def drop_rare(self) -> None:
        """Keeps half a store of the units seen most, none of them seen only once."""
        import numpy as np

        kept = np.flatnonzero(self.seen > 1)
        if len(kept) > STORE_MOST // 2:
            kept = np.sort(kept[np.argpartition(self.seen[kept], -(STORE_MOST // 2))[-(STORE_MOST // 2):]])
        names = list(self.known)
        self.known = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.seen, self.exact = self.seen[kept] >> 1, self.exact[kept]
        for side, (ids, starts) in enumerate(zip(self.stored, self.starts)):
            at, count = _runs(starts, kept)
            self.stored[side], self.starts[side] = ids[at], np.append(0, np.cumsum(count))

    def units(self, text: str) -> list[str]:
        """``text`` in units, each the next after one space; either tokenizer encodes them one by one as it would the whole."""
        return self.cut.split(text) if self.cut else [text]

    def encode(self, texts: list[str]):
        """Per side (ids, tokens of each text) of space+text, and whether each text's units are all given back.

        A unit is encoded once and its ids are remembered."""
        import numpy as np

        if len(self.known) > STORE_MOST:
            self.drop_rare()
        rows = [self.units(t) for t in texts]
        new = list(set().union(*rows).difference(self.known)) if rows else []
        if new:
            self._store(new)
        sizes = np.array([len(r) for r in rows], np.int64)
        unit = np.fromiter(map(self.known.__getitem__, chain.from_iterable(rows)), np.int64, int(sizes.sum()))
        self.seen += np.bincount(unit, minlength=len(self.seen))
        row = np.repeat(np.arange(len(rows)), sizes)
        sides = []
        for ids, starts in zip(self.stored, self.starts):
            at, count = _runs(starts, unit)
            sides.append((ids[at].astype(np.int64), np.bincount(row, weights=count, minlength=len(rows)).astype(np.int64)))
        exact = np.bincount(row, weights=~self.exact[unit], minlength=len(rows)) == 0
        return *sides, exact

    def _encode_a(self, units: list[str], joined: bytes, size):
        """(A's ids, tokens of each unit) of space+unit, ``size`` bytes each, ``joined`` their bytes on end.

        Units between which ``cut`` would split are encoded many at a time; the token bytes, if all given
        back, tell the units apart."""
        import numpy as np

        encode = lambda texts: [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        if self.cut:
            texts, n = [], 0
            while n < len(units):
                begin = n
                n += 1
                while n < len(units) and n < begin + _JOINED and units[n - 1][-1:] in self.beside_cut and units[n][:1] in self.beside_cut:
                    n += 1
                texts.append(" " + " ".join(units[begin:n]))
            flat = np.fromiter(chain.from_iterable(encode(texts)), np.int64)
            if b"".join(map(self.a_bytes.__getitem__, flat.tolist())) == joined:
                ends, at = np.cumsum(size), np.cumsum(self.a_size[flat])
                last = np.searchsorted(at, ends)
                if (at[last] == ends).all():
                    return flat, np.diff(last, prepend=-1)
        ids = encode([" " + u for u in units])
        return np.fromiter(chain.from_iterable(ids), np.int64), np.array([len(i) for i in ids], np.int64)

    def _store(self, units: list[str]) -> None:
        import numpy as np

        whole = [(" " + u).encode() for u in units]
        size = np.array([len(w) for w in whole], np.int64)
        joined = b"".join(whole)
        exact = np.ones(len(units), bool)
        ids = self.b.encode(units, num_threads=1)
        side_b = np.fromiter(chain.from_iterable(ids), np.int64), np.array([len(i) for i in ids], np.int64)
        given = np.frombuffer(joined, np.uint8)
        for side, ((flat, count), token_bytes, token_size) in enumerate(zip((self._encode_a(units, joined, size), side_b), (self.a_bytes, self.b_bytes), (self.a_size, self.b_size))):
            ends = np.cumsum(count)
            self.stored[side] = np.concatenate([self.stored[side], flat.astype(np.int32)])
            self.starts[side] = np.concatenate([self.starts[side], self.starts[side][-1] + ends])
            same = np.diff(np.append(0, np.cumsum(token_size[flat]))[np.append(0, ends)]) == size
            back = b"".join(map(token_bytes.__getitem__, flat[np.repeat(same, count)].tolist()))
            differs = np.frombuffer(back, np.uint8) != given[np.repeat(same, size)]
            if differs.any():
                same[np.repeat(np.flatnonzero(same), size[same])[differs]] = False
            exact &= same
        self.exact = np.concatenate([self.exact, exact])
        self.seen = np.concatenate([self.seen, np.zeros(len(units), np.int64)])
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))


def _runs(starts, which):
    """(places, lengths) of the runs ``which`` of values whose runs begin at ``starts``."""
    import numpy as np

    count = starts[which + 1] - starts[which]
    before = np.cumsum(count) - count
    return np.repeat(starts[which] - before, count) + np.arange(int(count.sum())), count


@lru_cache(maxsize=2)
def tokenizer_pair(byte_level: str, pieces: str) -> Pair:
    return Pair(byte_level, pieces)


def common_cuts(a_ends, b_ends, a_first, b_first):
    """(A token, B token) at the end of every leaf group, in order.

    ``a_ends`` and ``b_ends`` are the ascending end offsets of both sides' tokens over several texts on
    end; ``a_first`` and ``b_first`` the numbers of each text's first tokens.  Every text ends on both
    sides.  A cutless zone is looked through only while it's in the middle of an interval, at most
    a few times."""
    import numpy as np

    lo, hi = a_first, np.append(a_first[1:], len(a_ends)) - 1
    blo, bhi = b_first, np.append(b_first[1:], len(b_ends)) - 1
    leaves_a, leaves_b = [], []
    while len(lo):
        # one token on either side leaves no place for a cut
        single = (lo == hi) | (blo == bhi)
        leaves_a.append(hi[single])
        leaves_b.append(bhi[single])
        lo, hi, blo, bhi = lo[~single], hi[~single], blo[~single], bhi[~single]
        middle = (lo + hi - 1) >> 1
        cut_a = np.full(len(lo), -1, np.int64)
        cut_b = cut_a.copy()
        pending, inner, outer = np.arange(len(lo)), -1, 0
        while len(pending):  # look inner < distance <= outer tokens from the middle
            m = middle[pending]
            left = np.maximum(m - outer, lo[pending])
            right = np.minimum(m + outer, hi[pending] - 1)
            if inner < 0:
                probe, owner = m, np.arange(len(pending))
            else:
                n_left = np.maximum(m - inner - left, 0)
                n_right = np.maximum(right - (m + inner), 0)
                count = n_left + n_right
                owner = np.repeat(np.arange(len(pending)), count)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                probe = np.where(place < n_left[owner], left[owner] + place, m[owner] + inner + 1 + place - n_left[owner])
            at = np.searchsorted(b_ends, a_ends[probe])
            hit = b_ends[at] == a_ends[probe]
            probe, at, owner = probe[hit], at[hit], owner[hit]
            nearest = np.lexsort((probe, np.abs(probe - m[owner]), owner))
            first = nearest[np.append(True, np.diff(owner[nearest]) != 0)] if len(nearest) else nearest
            cut_a[pending[owner[first]]] = probe[first]
            cut_b[pending[owner[first]]] = at[first]
            open_ends = (left > lo[pending]) | (right < hi[pending] - 1)
            pending = pending[(cut_a[pending] < 0) & open_ends]
            inner, outer = outer, 2 * outer + 2
        cutless = cut_a < 0
        leaves_a.append(hi[cutless])
        leaves_b.append(bhi[cutless])
        halves = [np.stack(x, 1)[~cutless].ravel() for x in ((lo, cut_a + 1), (cut_a, hi), (blo, cut_b + 1), (cut_b, bhi))]
        lo, hi, blo, bhi = halves
    a = np.concatenate(leaves_a) if leaves_a else np.zeros(0, np.int64)
    b = np.concatenate(leaves_b) if leaves_b else np.zeros(0, np.int64)
    order = np.argsort(a)
    return a[order], b[order]


class Aligned:
    """The tokens of a list of texts (bytes, NULL as empty) by both tokenizers, and their common groups."""

    def __init__(self, pair: Pair, texts: list[bytes]):
        import numpy as np

        usable = [t.decode("utf-8", "replace") for t in texts]
        (a, n_a), (b, n_b), exact = pair.encode(usable)
        ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
        used = np.array([bool(t) for t in texts], bool)
        for row in np.flatnonzero(~exact | [u.encode() != t for u, t in zip(usable, texts)]).tolist():
            # units that aren't given back: the whole text decides
            sides = (a[ends_a[row] - n_a[row] : ends_a[row]], pair.a_bytes), (b[ends_b[row] - n_b[row] : ends_b[row]], pair.b_bytes)
            used[row] &= all(b"".join(map(of.__getitem__, ids.tolist())) == b" " + texts[row] for ids, of in sides)
        self.pair = pair
        self.a, self.b = a[np.repeat(used, n_a)], b[np.repeat(used, n_b)]
        self.n_a, self.n_b = n_a * used, n_b * used
        self.a_at, self.b_at = (np.concatenate([[0], np.cumsum(n)]).astype(np.int64) for n in (self.n_a, self.n_b))
        self.a_ends, self.b_ends = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        some = self.n_a > 0
        self.cut_a, self.cut_b = common_cuts(self.a_ends, self.b_ends, self.a_at[:-1][some], self.b_at[:-1][some])
        self.first = np.searchsorted(self.cut_a, self.a_at)  # each text's first group

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; empty for texts without tokens."""
        import hashlib

        import numpy as np

        n_names = len(self.pair.a_bytes)
        begin_b = np.concatenate([[0], self.cut_b[:-1] + 1]) if len(self.cut_b) else self.cut_b
        group_a = np.repeat(np.arange(len(self.cut_a)), np.diff(self.cut_a, prepend=-1))
        group_b = np.repeat(np.arange(len(self.cut_b)), np.diff(self.cut_b, prepend=-1))
        sequence = np.empty(len(self.a) + len(self.b), np.int64)
        name_a, name_b = self.a.copy(), self.b + 2 * n_names
        name_a[self.cut_a] += n_names
        name_b[self.cut_b] += len(self.pair.b_bytes)
        sequence[np.arange(len(self.a)) + begin_b[group_a]] = name_a
        sequence[np.arange(len(self.b)) + self.cut_a[group_b] + 1] = name_b
        at = self.a_at + self.b_at
        names = self.pair.names
        return [hashlib.sha256(b"".join(names[sequence[s:e]].tolist())[:-1]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]

    def links(self):
        """(codes, counts, offsets): each text's distinct linked id pairs and how often they are linked.

        Tokens aren't empty, so at a common offset just one token of either side ends: a group's last ones."""
        import numpy as np

        codes = (self.a[self.cut_a] << _B_BITS) | self.b[self.cut_b]
        row = np.repeat(np.arange(len(self.n_a)), np.diff(self.first))
        order = np.lexsort((codes, row))
        codes, row = codes[order], row[order]
        new = np.append(True, (np.diff(codes) != 0) | (np.diff(row) != 0)) if len(codes) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        counts = np.diff(np.append(start, len(codes)))
        offsets = np.searchsorted(row[start], np.arange(len(self.n_a) + 1))
        return codes[start], counts, offsets

    def groups(self) -> list[list[dict]]:
        """Each text's groups: end offsets in space+text, A's ids and B's ids."""
        out = []
        for row in range(len(self.n_a)):
            found, a, b = [], int(self.a_at[row]), int(self.b_at[row])
            base = int(self.a_ends[a - 1]) if a else 0
            for g in range(int(self.first[row]), int(self.first[row + 1])):
                a_end, b_end = int(self.cut_a[g]) + 1, int(self.cut_b[g]) + 1
                found.append({"end": int(self.a_ends[a_end - 1]) - base, "a": self.a[a:a_end].tolist(), "b": self.b[b:b_end].tolist()})
                a, b = a_end, b_end
            out.append(found)
        return out


_ROW = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType())]
_GROUPS = T.ArrayType(T.StructType([T.StructField("end", T.LongType()), T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType()))]))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: bool = True, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, codes, counts, groups_sha256[, groups]) of every row of ``docs``.

    space+text is encoded by A (byte-level BPE), the text by B (which adds the space), both without
    special tokens.  ``groups`` holds the finest groups of tokens whose byte ranges coincide; ``codes``
    and ``counts`` the id pairs that end groups (see ``links``).

    NULL and empty texts, and those that a tokenizer doesn't give back byte by byte, have no
    tokens, groups or digest.  Repeated rows and NULL ids give their rows, an empty table none;
    other columns are ignored.  Rows stay in their tasks; nothing is shuffled.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    fields = [T.StructField(n, t) for n, t in _ROW]
    fields += [T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("groups_sha256", T.StringType())]
    fields += [T.StructField("groups", _GROUPS)] if groups else []
    schema = T.StructType([source.schema["doc_id"], *fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        pair, arrow = tokenizer_pair(byte_level, pieces), to_arrow_schema(schema)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                found = Aligned(pair, [t or b"" for t in part.column("text").to_pylist()])
                codes, counts, offsets = found.links()
                offsets = pa.array(offsets, pa.int32())
                columns = [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.first[1:] - found.first[:-1]))]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(codes, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))]
                columns.append(pa.array(found.digests(), pa.string()))
                if groups:
                    columns.append(pa.array(found.groups(), arrow.field("groups").type))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(run, schema)


def link_counts(rows: DataFrame) -> DataFrame:
    """(code, n_linked, best) of every linked id pair: corpus-wide links, and whether its B id has none with more.

    Of a linked pair, one token's bytes end with the other's, so the vocabularies bound this table: at most
    as many rows as their tokens have suffixes (some 700,000 for the two public ones), at any input size."""
    counted = rows.select(F.inline(F.arrays_zip("codes", "counts"))).groupBy("codes").agg(F.sum("counts").alias("n_linked"))
    counted = counted.select(F.col("codes").alias("code"), "n_linked", F.col("codes").bitwiseAND(F.lit((1 << _B_BITS) - 1)).alias("b"))
    most = counted.groupBy("b").agg(F.max("n_linked").alias("most"))
    return counted.join(most, "b").select("code", "n_linked", (F.col("n_linked") == F.col("most")).alias("best"))


def alignment_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    The rows' groups and linked pairs are written once; the counts of all pairs, bounded by the
    vocabularies, go to every task.  Rows as in ``aligned``; without tokens all counts are 0 and the digest is ''."""
    rows = written(aligned(docs, id_col, text_col, groups=False, byte_level=byte_level, pieces=pieces))
    pairs = written(link_counts(rows)).toArrow()
    names = ["n_links", "n_best", "count_sum"]
    schema = T.StructType([f for f in rows.schema if f.name not in ("codes", "counts")] + [T.StructField(n, T.LongType()) for n in names])
    shared = rows.sparkSession.sparkContext.broadcast(_lookup(pairs))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        code, linked, best = shared.value
        for batch in batches:
            codes = batch.column("codes")
            sizes = np.diff(codes.offsets.to_numpy())
            codes = codes.flatten().to_numpy()
            counts = batch.column("counts").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(code, codes)
            end = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * best[at], counts * linked[at])] if len(code) else [np.zeros(1, np.int64)] * 3
            found = {n: pa.array(s[end] - s[end - sizes], pa.int64()) for n, s in zip(names, sums)}
            yield pa.RecordBatch.from_arrays([found.get(f.name) if f.name in found else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    found = rows.mapInArrow(run, schema)
    return found.select("doc_id", "n_a", "n_b", "n_groups", *names, "groups_sha256")


def _lookup(pairs):
    import numpy as np

    code, linked, best = (pairs.column(c).to_numpy() for c in ("code", "n_linked", "best"))
    order = np.argsort(code)
    return code[order], linked[order].astype(np.int64), best[order].astype(np.int64)
