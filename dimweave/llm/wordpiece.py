"""Token counts by a linear longest-match automaton.

Greedy longest-match-first word pieces need, at each point, the longest
vocabulary entry.  The automaton is a trie over the vocabulary in which a node
v without the wanted edge knows the pieces that greedy matching would pop for
v's string, and the node of what is left (its failure link).  Only their
number is kept, so counting is one walk over the characters and no piece is
ever built.

A vocabulary has word-initial entries (written with a mark such as U+2581) and
continuing entries (the others).  A word that cannot be covered counts as one
unknown token, as word-piece tokenizers do.

Edge cases: null, empty or blank texts have no words and no tokens; words of
any length are walked whole; equal rows are counted one by one; a null doc_id
is carried along; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A word: letters, digits and underscores, or one other visible character.
WORD = re.compile(r"\w+|[^\w\s]")
REMEMBERED = 300_000
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


class PieceCounter:
    """Counts greedy pieces of single words over a trie with failure links."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        edges: list[dict[str, int]] = [{}, {}]  # 0: start of a word, 1: inside a word
        piece = [False, False]
        for root, entries in ((0, initial), (1, continuing)):
            for entry in entries:
                at = root
                for ch in entry:
                    at = edges[at][ch] if ch in edges[at] else self._grow(edges, piece, at, ch)
                if entry:
                    piece[at] = True
        # Breadth first, so that the links of shorter strings are there.
        link: list[int | None] = [None] * len(edges)
        pops = [0] * len(edges)
        queue = deque((0, 1))
        while queue:
            u = queue.popleft()
            for ch, v in edges[u].items():
                queue.append(v)
                if piece[v]:
                    link[v], pops[v] = 1, 1
                    continue
                z, n = link[u], pops[u]
                while z is not None and ch not in edges[z]:
                    n, z = n + pops[z], link[z]
                if z is not None:
                    link[v], pops[v] = edges[z][ch], n
        self.edges, self.link, self.pops = edges, link, pops

    @staticmethod
    def _grow(edges, piece, at, ch):
        edges[at][ch] = len(edges)
        edges.append({})
        piece.append(False)
        return len(edges) - 1

    def __call__(self, word: str) -> int:
        """Number of pieces; 0 if the word has no cover."""
        edges, link, pops = self.edges, self.link, self.pops
        u, n = 0, 0
        for ch in word:
            while ch not in edges[u]:
                if link[u] is None:
                    return 0
                n, u = n + pops[u], link[u]
            u = edges[u][ch]
        while u != 1:
            if link[u] is None:
                return 0
            n, u = n + pops[u], link[u]
        return n


def sentencepiece_entries(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Initial and continuing entries of a sentencepiece vocabulary; its control
    and byte entries are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = [model.id_to_piece(i) for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [e[1:] for e in entries if e[0] == mark], [e for e in entries if e[0] != mark]


def _count(entries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, known = PieceCounter(*entries.value), {}
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = WORD.findall(text or "")
                if len(known) > REMEMBERED:
                    known.clear()
                for w in set(words).difference(known):
                    known[w] = count(w)
                counts = [known[w] for w in words]
                unknown = counts.count(0)
                out.append((doc, len(words), sum(counts) + unknown, unknown))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                 names=["doc_id", "n_words", "n_tokens", "n_unknown"])
    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown of every document; ``path`` is a
    sentencepiece vocabulary, read once on the driver and shipped to the tasks
    (its size is the vocabulary's, whatever the input's)."""
    entries = docs.sparkSession.sparkContext.broadcast(sentencepiece_entries(path))
    return docs.select("doc_id", "text").mapInArrow(_count(entries), SCHEMA)
