"""Edit-aware token counts: a balanced segment tree over each document's pre-tokens.

A text is cut into leaves of about `leaf` characters, only where the pre-token pattern of the
vocabulary ends a pre-token whatever stands around: before white space, and where letters, digits
and signs change into each other (but not after an apostrophe, which may begin a contraction), never
inside a special token. BPE doesn't cross pre-tokens, so counts of leaves add up exactly. A single
pre-token, such as a run of letters without spaces or signs, is one leaf however long it is.

Inner nodes hold the characters, tokens and leaves of their subtrees; the tree is kept balanced by
height, so an edit that changes the number of leaves updates the sums on its path and nothing else. An edit
re-encodes the leaves it touches, and a neighbour too where the characters that a cut stands on have
changed.

A null text is empty and has no tokens. Rows that share an id are separate documents. Edits are
in code points of the text as the edits before have left it; places beyond the end mean the end.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c
from .packing import default_vocabulary, encoder, special_tokens

CUT = regex.compile(r"(?<=[\p{L}\p{N}\p{P}\p{S}])(?=[ \t\n\r])|(?<=\p{L})(?=[\p{N}\p{P}\p{S}])|(?<=\p{N})(?=[\p{L}\p{P}\p{S}])|(?<=(?!')[\p{P}\p{S}])(?=[\p{L}\p{N}])")


def _splits(special: Sequence[str], before: str, after: str) -> bool:
    """Whether a special token stands across the place between two texts."""
    return any(s in before[max(0, len(before) - len(s) + 1) :] + after[: len(s) - 1] for s in special)


def cuts(text: str, leaf: int, special: Sequence[str] = ()) -> list[str]:
    """The text in leaves."""
    out, start, at, reach = [], 0, leaf, max(map(len, special), default=1)
    while len(text) - start > leaf:
        m = CUT.search(text, at)
        if m is None or m.start() >= len(text):
            break
        at = m.start()
        if _splits(special, text[max(0, at - reach) : at], text[at : at + reach]):
            at += 1
            continue
        out.append(text[start:at])
        start, at = at, at + leaf
    return [*out, text[start:]] if start < len(text) else out


@dataclass(slots=True)
class Node:
    """A leaf with its text, or the sums of two subtrees."""

    chars: int
    tokens: int
    leaves: int = 1
    height: int = 0
    text: str = ""
    left: Node | None = None
    right: Node | None = None


def _over(a: Node, b: Node) -> Node:
    return Node(a.chars + b.chars, a.tokens + b.tokens, a.leaves + b.leaves, 1 + max(a.height, b.height), "", a, b)


def _balanced(a: Node, b: Node) -> Node:
    """Over two trees whose heights differ by two at most."""
    if a.height > b.height + 1:
        if a.left.height >= a.right.height:
            return _over(a.left, _over(a.right, b))
        return _over(_over(a.left, a.right.left), _over(a.right.right, b))
    if b.height > a.height + 1:
        if b.right.height >= b.left.height:
            return _over(_over(a, b.left), b.right)
        return _over(_over(a, b.left.left), _over(b.left.right, b.right))
    return _over(a, b)


def join(a: Node | None, b: Node | None) -> Node | None:
    """One balanced tree of two, in steps as many as their heights differ."""
    if a is None or b is None:
        return a or b
    if a.height > b.height + 1:
        return _balanced(a.left, join(a.right, b))
    if b.height > a.height + 1:
        return _balanced(join(a, b.left), b.right)
    return _over(a, b)


def split(node: Node | None, k: int) -> tuple[Node | None, Node | None]:
    """The tree of the first k leaves, and that of the rest."""
    if node is None or k <= 0:
        return None, node
    if k >= node.leaves:
        return node, None
    if k <= node.left.leaves:
        a, b = split(node.left, k)
        return a, join(b, node.right)
    a, b = split(node.right, k - node.left.leaves)
    return join(node.left, a), b


class TokenTree:
    """A text's leaves and sums; `encoded` counts the characters that were given to the encoder."""

    def __init__(self, text: str, count: Callable[[str], int], leaf: int = 512, special: Sequence[str] = ()) -> None:
        self.count, self.leaf, self.special, self.encoded = count, leaf, tuple(special), 0
        self.reach = max([1, *(len(s) - 1 for s in self.special)])
        self.root = self._built(cuts(text, leaf, self.special))

    def _built(self, texts: Sequence[str]) -> Node | None:
        if len(texts) < 2:
            return self._measured(texts[0]) if texts else None
        half = len(texts) // 2
        return _over(self._built(texts[:half]), self._built(texts[half:]))

    def _measured(self, text: str) -> Node:
        self.encoded += len(text)
        return Node(len(text), self.count(text), text=text)

    @property
    def chars(self) -> int:
        return self.root.chars if self.root else 0

    @property
    def tokens(self) -> int:
        return self.root.tokens if self.root else 0

    @property
    def leaves(self) -> int:
        return self.root.leaves if self.root else 0

    def _leaf(self, i: int) -> str:
        node = self.root
        while node.height:
            if i < node.left.leaves:
                node = node.left
            else:
                i, node = i - node.left.leaves, node.right
        return node.text

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one at the end), and the place in it."""
        node, i = self.root, 0
        while node.height:
            if place < node.left.chars:
                node = node.left
            else:
                place, i, node = place - node.left.chars, i + node.left.leaves, node.right
        return i, place

    def _near(self, i: int, step: int) -> str:
        """What stands next to a place: `reach` characters of the leaves from i on, or back from i."""
        out = ""
        while 0 <= i < self.leaves and len(out) < self.reach:
            out = out + self._leaf(i) if step > 0 else self._leaf(i) + out
            i += step
        return out

    def _cuttable(self, before: str, after: str) -> bool:
        return CUT.match(before[-1:] + after[:1], 1) is not None and not _splits(self.special, before, after)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces text[start:end]."""
        start, end = min(max(start, 0), self.chars), min(max(start, end, 0), self.chars)
        if start == end and not new:
            return
        if self.root is None:
            self.root = self._built(cuts(new, self.leaf, self.special))
            return
        first, a = self._leaf_at(start)
        last, b = self._leaf_at(end)
        text = self._leaf(first)[:a] + new + self._leaf(last)[b:]
        while True:  # a cut stands on what is before and after it
            if last + 1 < self.leaves and not self._cuttable((self._near(first - 1, -1) + text)[-self.reach - 1 :], self._near(last + 1, 1)):
                last += 1
                text += self._leaf(last)
            elif first and not self._cuttable(self._near(first - 1, -1), (text + self._near(last + 1, 1))[: self.reach + 1]):
                first -= 1
                text = self._leaf(first) + text
            else:
                break
        rest, after = split(self.root, last + 1)
        before, _ = split(rest, first)
        self.root = join(join(before, self._built(cuts(text, self.leaf, self.special))), after)

    def text(self) -> str:
        return "".join(self._leaf(i) for i in range(self.leaves))


def count_with_edits(docs: DataFrame, edits: Callable[[str], list[tuple[int, int, str]]], vocabulary: str | None = None, leaf: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, n_leaves, n_edits, n_tokens_edited,
    n_chars_edited, n_chars_reencoded (by all edits together)."""
    vocabulary = vocabulary or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        size = lambda text: len(encode(text))
        special = special_tokens(vocabulary)
        names = ["n_tokens", "n_leaves", "n_edits", "n_tokens_edited", "n_chars_edited", "n_chars_reencoded"]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                tree = TokenTree(text, size, leaf, special)
                row = [tree.tokens, tree.leaves]
                tree.encoded = 0
                todo = edits(text)
                for e in todo:
                    tree.edit(*e)
                rows.append([*row, len(todo), tree.tokens, tree.chars, tree.encoded])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(6))], ["doc_id", *names])

    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_tokens long, n_leaves long, n_edits long, n_tokens_edited long, n_chars_edited long, n_chars_reencoded long")


def revision(text: str) -> list[tuple[int, int, str]]:
    """A revision that any text can have: its middle character goes and a note comes in a quarter from the start."""
    half = len(text) // 2
    return [(half, half + 1, ""), (len(text) // 4, len(text) // 4, " (revised)")] if text else []
