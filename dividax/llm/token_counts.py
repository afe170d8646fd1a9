"""Token counts: unigram segmentation by dynamic programming shared along trie prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices

#: Rank file of a public byte-level vocabulary: a base64 piece and its rank on each line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text into pre-tokens; every character belongs to one (pattern of the public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a worker remembers between batches; beyond it the store starts anew.
STORE_MOST = 400_000


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Log probability of each piece: Zipf's law over the file's ranks, adding up to one."""
    import base64
    import math

    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}


class PrefixTrie:
    """Counts the tokens of pre-tokens, walking them as the trie of their bytes.

    Pre-tokens are visited in byte order, which is a depth-first walk of their trie: the path from
    the root to the current node holds, for each prefix, the best forward score of the unigram
    model and the number of tokens on that best path (fewest where scores tie).  A prefix that
    pre-tokens share is scored once.  A byte outside the vocabulary is one unknown token, below
    every piece.  Only the path and the terminal counts are kept."""

    def __init__(self, scores: dict[bytes, float], store_most: int = STORE_MOST):
        self.scores, self.store_most = scores, store_most
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.tails = {p[i:] for p in scores for i in range(len(p))}
        self.terminal: dict[str, int] = {}
        self.scored = 0

    def insert(self, pretokens) -> None:
        """Store the token count of every pre-token that has none yet."""
        if len(self.terminal) > self.store_most:
            self.terminal.clear()
        new = sorted((t.encode(), t) for t in pretokens if t not in self.terminal)
        best, count, before = [0.0], [0], b""
        scores, tails, unknown = self.scores, self.tails, self.unknown
        for word, name in new:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, tokens = best[end - 1] + unknown, count[end - 1] + 1
                for begin in range(end - 1, -1, -1):
                    piece = word[begin:end]
                    if piece not in tails:
                        break
                    if piece in scores:
                        score = best[begin] + scores[piece]
                        if score > top or score == top and count[begin] + 1 < tokens:
                            top, tokens = score, count[begin] + 1
                best.append(top)
                count.append(tokens)
            self.scored += len(word) - shared
            self.terminal[name] = count[len(word)]
            before = word


@lru_cache(maxsize=4)
def _worker_trie(path: str) -> PrefixTrie:
    return PrefixTrie(read_vocabulary(path))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every row of ``docs``; other columns are ignored.

    A pre-token is segmented into the pieces of greatest total log probability.  The vocabulary
    file must be at the same path on every executor.  NULL and empty texts have 0 tokens; white
    space counts as text; repeated rows and NULL ids give their rows; an empty table gives none.
    Texts of any length are read whole, a slice of the batch's distinct pre-tokens at a time; no
    rows are shuffled.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_pretokens", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        split, trie = regex.compile(PATTERN).findall, _worker_trie(vocabulary)
        for batch in batches:
            for part in text_slices(batch, "text"):
                pretokens = [split(text or "") for text in part.column("text").to_pylist()]
                trie.insert(set().union(*pretokens))
                of = trie.terminal.__getitem__
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(p) for p in pretokens], pa.int64()), pa.array([sum(map(of, p)) for p in pretokens], pa.int64())],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
