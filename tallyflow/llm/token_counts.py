"""Token counts under a unigram vocabulary: one forward pass over a trie of the distinct pre-tokens."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Nodes and distinct pre-tokens that a worker keeps. Beyond the first its trie starts anew; beyond half the second, counts that were not
#: asked for since the last time go. Longer words stay out of the trie.
NODES, CACHED, LONGEST = 500_000, 300_000, 200


def unigram_scores(model: str) -> dict[str, float]:
    """Log probabilities of the pieces of a public sentencepiece vocabulary.

    None of the public files at hand holds a unigram model: the scores of this one are ranks of its merges. So the probabilities
    follow Zipf's law over the rank: log(1 / (rank * H)).
    """
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model)
    pieces = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    pieces.sort(key=lambda i: (-p.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p.id_to_piece(i): -math.log(r) - total for r, i in enumerate(pieces, 1)}


class Lengths(dict):
    """By the last three characters of a text: the lengths, in order, of the pieces that may end there."""

    def __missing__(self, end: str) -> tuple[int, ...]:
        self[end] = found = self[end[1:]] if end else ()
        return found


class Trie:
    """A trie of pre-tokens whose nodes hold the best forward score of their prefix and its number of tokens; terminal counts are kept by word.

    A character that no piece covers costs its UTF-8 bytes. Of equal scores the segmentation with fewer tokens counts.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest, self.byte_score = scores, max(map(len, scores)), min(scores.values()) - 10.0
        found: dict[str, set[int]] = {}
        for piece in scores:
            found.setdefault(piece[-3:], set()).add(len(piece))
        self.found = {end: tuple(sorted(set().union(*(found.get(end[k:], ()) for k in range(len(end)))))) for end in found}
        self.terminal: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.lengths = Lengths(self.found)
        self.child: dict[int, int] = {}  # by node and character in one number
        self.score, self.count = [0.0], [0]

    def step(self, text: str, end: int, at: list[int], score: list[float], count: list[int]) -> tuple[float, int]:
        """The best score of text[:end] and its tokens, from those of the prefixes before: prefix k stands at ``at[k]`` of the two lists."""
        last = text[end - 1]
        cost = 1 if last < "\x80" else len(last.encode("utf-8", "surrogatepass"))
        best, tokens = score[at[-1]] + cost * self.byte_score, count[at[-1]] + cost
        for n in self.lengths[text[max(0, end - 3) : end]]:
            if n > end:
                break
            s = self.scores.get(text[end - n : end])
            if s is not None:
                k = at[-n]
                total = score[k] + s
                if total > best or total == best and count[k] + 1 < tokens:
                    best, tokens = total, count[k] + 1
        return best, tokens

    def insert(self, word: str) -> int:
        """Tokens of the best segmentation of the word, the mark of its start included. Only nodes that no word had before are scored."""
        text = MARK + word
        if len(text) > LONGEST:
            return self.alone(text)
        node, path, child = 0, [0], self.child
        for end, last in enumerate(map(ord, text), 1):
            key = node << 21 | last
            node = child.get(key, 0)
            if not node:
                best, tokens = self.step(text, end, path, self.score, self.count)
                node = child[key] = len(self.score)
                self.score.append(best)
                self.count.append(tokens)
            path.append(node)
        return self.count[node]

    def alone(self, text: str) -> int:
        """The same for a very long word, with the last prefixes alone in memory."""
        score, count = [0.0], [0]
        for end in range(1, len(text) + 1):
            best, tokens = self.step(text, end, list(range(len(score))), score, count)
            score, count = [*score[-self.longest + 1 :], best], [*count[-self.longest + 1 :], tokens]
        return count[-1]

    def counts(self, words: list[bytes]) -> list[int]:
        """The terminal count of each word."""
        new = set(words).difference(self.terminal)
        if len(self.score) > NODES:
            self.clear()
            new = set(words)
        if len(self.terminal) + len(new) > CACHED // 2:
            self.before, self.terminal = self.terminal, {}
            new = set(words)
        for w in new:
            n = self.before.get(w)
            self.terminal[w] = self.insert(w.decode()) if n is None else n
        return list(map(self.terminal.__getitem__, words))


#: By vocabulary file; a worker keeps its trie over its tasks.
_tries: dict[str, Trie] = {}


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_pretokens, n_tokens.

    Pre-tokens are the words between space and U+0009 to U+000D, however long. A worker's distinct pre-tokens go into one trie; forward scores are
    worked out once for each shared prefix, and every pre-token's terminal count is then looked up. Null and blank texts have 0
    tokens; repeated rows are counted each; a null doc_id is carried along; an empty table gives no rows.
    """

    def run(batches):
        import pyarrow as pa

        if model not in _tries:
            _tries[model] = Trie(unigram_scores(model))
        trie = _tries[model]
        for batch in batches:
            pre, tokens = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                pre.append(len(words))
                tokens.append(sum(trie.counts(words)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
