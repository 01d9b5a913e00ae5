"""Token counts by a linear longest-match automaton.

Greedy word-piece splitting takes the longest vocabulary piece at the start
of a word, then the longest continuation piece, and so on.  The automaton is
the trie of the vocabulary (start pieces below one root, continuation pieces
below another) with, per node, a failure link and the number of pieces popped
when that link is followed, both computed once over the trie.  A word is then
counted in one pass over its characters: follow the edge, or else pop and
follow the failure link.  No piece is ever built or looked up again.

A vocabulary may hold the bare word mark (the empty start piece): a word that
no longer start piece begins then starts with the mark, one piece, and goes
on with continuation pieces.  A word that cannot be split whole counts as one
unknown piece.  Words are ``[^\\x20\\x09-\\x0D]+`` unless another split is
passed.

The vocabulary is a fixed file of a public tokenizer (its path a parameter);
the automaton is built on the driver from its at most a few hundred thousand
pieces and shipped to the tasks once as a broadcast variable.  A vocabulary's
size does not grow with the documents.

Edge cases: null or blank text has 0 words, 0 pieces; repeated rows repeat;
texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import slices, split_words, texts, word_ids


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Start and continuation pieces of a sentencepiece model file: pieces
    with the word mark start a word (the bare mark is the empty start piece),
    the others continue one.  Control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    start, rest = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith("▁"):
            if "▁" not in piece[1:]:
                start.append(piece[1:])
        elif "▁" not in piece:
            rest.append(piece)
    return start, rest


class LongestMatch:
    """The automaton.  Nodes are numbered breadth first by insertion; node 0
    is the root of start pieces, node 1 that of continuation pieces.  An empty
    start piece links node 0 to node 1 with one popped piece."""

    def __init__(self, start: Iterable[str], rest: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        bare = False
        for root, pieces in ((0, start), (1, rest)):
            for piece in pieces:
                at = root
                for c in piece:
                    nxt = self.edges[at].get(c)
                    if nxt is None:
                        nxt = self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        final.append(False)
                    at = nxt
                if at > 1:
                    final[at] = True
                elif root == 0:
                    bare = True
        n = len(self.edges)
        # Failure link (-1: none, the word is unknown) and popped pieces.
        self.fail, self.pops = [-1] * n, [0] * n
        if bare:
            self.fail[0], self.pops[0] = 1, 1
        level = [(r, c, v) for r in (0, 1) for c, v in self.edges[r].items()]
        while level:
            below = []
            for u, c, v in level:
                if final[v]:
                    self.fail[v], self.pops[v] = 1, 1
                else:
                    z, popped = self.fail[u], self.pops[u]
                    while z != -1 and c not in self.edges[z]:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z != -1:
                        self.fail[v], self.pops[v] = self.edges[z][c], popped
                below += [(v, d, w) for d, w in self.edges[v].items()]
            level = below

    def count(self, word: str) -> int:
        """Pieces of one word, 0 if it cannot be split."""
        edges, fail, pops = self.edges, self.fail, self.pops
        at, n = 0, 0
        for c in word:
            nxt = edges[at].get(c)
            while nxt is None:
                n += pops[at]
                at = fail[at]
                if at == -1:
                    return 0
                nxt = edges[at].get(c)
            at = nxt
        while at != 1:  # pop what is left; 1 is reached exactly at a piece end
            n += pops[at]
            at = fail[at]
            if at == -1:
                return 0
        return n


def count_pieces(docs: DataFrame, automaton: LongestMatch, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_pieces`` (unknown words
    count one), ``n_unknown``."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    @F.arrow_udf("struct<n_words:long,n_pieces:long,n_unknown:long>")
    def counted(column: pa.Array) -> pa.Array:
        machine, col, rows = shared.value, texts(column), []
        for a, b in slices(col):
            offsets, flat = split_words(col.slice(a, b - a))
            ids, vocab = word_ids(flat)  # each distinct word of the slice is run once
            each = np.fromiter(map(machine.count, vocab.to_pylist()), np.int64, len(vocab))
            unknown = (each == 0).astype(np.int64)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[ids])])[offsets])
            rows.append((np.diff(offsets), total(each + unknown), total(unknown)))
        cols = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, np.int64) for i in range(3)]
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in cols], ["n_words", "n_pieces", "n_unknown"])

    return (
        docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
        .select("_i", counted("_t").alias("_c"))
        .select(F.col("_i").alias(id_col), "_c.*")
    )
