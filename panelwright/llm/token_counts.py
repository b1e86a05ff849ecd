"""Token counts with a linear longest-match automaton.

The vocabulary is a trie with failure links. Where a node has no edge for the next
character, its link leads to the node that remains after the longest matching pieces
have been popped off the front, and its count says how many pieces that were. A word
is read once, character by character, and its greedy longest-match piece count comes
out without any piece being built.

Words are runs of other characters than white space, with the vocabulary's word-start
marker put in front. A word with a part that no piece matches counts as one unknown
token, as word-piece tokenizers do.

Defined results: null and empty texts have no words and no tokens. Repeated rows are
counted row by row; other columns of the input are not read.
"""

import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame

from panelwright.llm.texts import map_texts, spaced_words, typed

MARKER = "▁"
CACHED_WORDS = 200_000  # word counts that a task remembers; it starts anew when they are full


class LongestMatch:
    """Greedy longest-match piece counts of words, in time linear in their length."""

    def __init__(self, pieces):
        self.edges: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for char in piece:
                following = self.edges[node].get(char)
                if following is None:
                    following = self.edges[node][char] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = following
            whole[node] = True
        whole[0] = False
        self.links: list[int] = [-1] * len(self.edges)  # -1: nothing can be popped
        self.popped: list[int] = [0] * len(self.edges)
        level = [0]
        while level:  # breadth first: links lead to shorter strings
            below = []
            for parent in level:
                for char, node in self.edges[parent].items():
                    below.append(node)
                    if whole[node]:
                        self.links[node], self.popped[node] = 0, 1
                        continue
                    at, count = self.links[parent], self.popped[parent]
                    while at >= 0 and char not in self.edges[at]:
                        count += self.popped[at]
                        at = self.links[at]
                    if at >= 0:
                        self.links[node], self.popped[node] = self.edges[at][char], count
            level = below

    def count(self, word: str) -> int:
        """Pieces of the word; -1 where some part of it matches no piece."""
        edges, links, popped = self.edges, self.links, self.popped
        node = count = 0
        for char in word:
            following = edges[node].get(char)
            while following is None:
                count += popped[node]
                node = links[node]
                if node < 0:
                    return -1
                following = edges[node].get(char)
            node = following
        while node:
            count += popped[node]
            node = links[node]
            if node < 0:
                return -1
        return count


@lru_cache(maxsize=2)
def _matcher(digest: str, pieces: tuple[str, ...]) -> LongestMatch:
    return LongestMatch(pieces)


def token_counts(
    df: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text", marker: str = MARKER
) -> DataFrame:
    """One row per document: id, n_words, n_tokens, n_unknown (words that count as one token)."""
    pieces = tuple(dict.fromkeys(p for p in pieces if p))
    digest = hashlib.sha256("\0".join(pieces).encode()).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary: its size does not follow the data

    def start():
        matcher = _matcher(digest, sent.value)
        known: dict[bytes, int] = {}

        def step(ids, texts):
            tokens, unknown, words_of = [], [], []
            for text in texts:
                words = spaced_words(text)
                try:
                    counts = [known[w] for w in words]
                except KeyError:
                    if len(known) > CACHED_WORDS:
                        known.clear()
                    for word in set(words).difference(known):
                        known[word] = matcher.count(marker + word.decode(errors="replace"))
                    counts = [known[w] for w in words]
                missed = counts.count(-1)
                words_of.append(len(words))
                tokens.append(sum(counts) + 2 * missed)
                unknown.append(missed)
            return [ids, words_of, tokens, unknown]

        return step

    return map_texts(df, [id_col, text_col], start, typed(df, id_col, "n_words long, n_tokens long, n_unknown long"))
