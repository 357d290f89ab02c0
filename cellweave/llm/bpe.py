"""Byte-level BPE: merges compiled into a lazily determinised transducer, and exact prefix counts.

Both rest on one property of BPE: a sequence of tokens is the encoding of its bytes exactly when
every neighbouring pair encodes to itself. So the encoding of a prefix ends in the one token t for
which the encoding before t ends in a token that may stand before t.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable

import regex

#: Sizes at which a worker forgets its memo tables (they only save time).
MEMO_WORDS, MEMO_STATES, MEMO_PAIRS = 300_000, 200_000, 1_000_000


class Merges:
    """Vocabulary and merge order; ``neighbours(a, b)`` tells whether token b may follow token a."""

    def __init__(self, tokens: list[bytes], pair_rank=None):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.pair_rank = pair_rank or (lambda a, b, get=self.ids.get: get(a + b))
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.proper = set()
        for t in tokens:
            parts, last = self._merge(t)
            if parts == [t]:
                self.proper.add(t)
                if last:
                    self.split[t] = last
        self.trie: list[dict[int, int]] = [{}]
        self.final: list[int] = [-1]
        for t in tokens:
            if t in self.proper:
                node = 0
                for b in t:
                    if b not in self.trie[node]:
                        self.trie[node][b] = len(self.trie)
                        self.trie.append({})
                        self.final.append(-1)
                    node = self.trie[node][b]
                self.final[node] = self.ids[t]
        self._pairs: dict[int, bool] = {}
        self._spines: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}

    @classmethod
    def ranks(cls, path: str) -> Merges:
        """A rank file: a token in base64 and its rank on each line."""
        with open(path, "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        if sorted(found.values()) != list(range(len(found))):
            raise ValueError(f"ranks in {path} have gaps")
        return cls(sorted(found, key=found.get))

    @classmethod
    def model_json(cls, path: str) -> tuple[Merges, list[str]]:
        """A JSON file with vocabulary and merges in the usual printable byte alphabet; also its added tokens."""
        with open(path, encoding="utf-8") as f:
            x = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
        added = [a["content"] for a in x.get("added_tokens", ())]
        tokens = [t for t in sorted(x["model"]["vocab"], key=x["model"]["vocab"].get) if t not in added]
        raw = lambda t: bytes(back[c] for c in t)
        rank = {tuple(map(raw, m if isinstance(m, list) else m.split(" "))): n for n, m in enumerate(x["model"]["merges"])}
        return cls([raw(t) for t in tokens], lambda a, b, get=rank.get: get((a, b))), added

    def _merge(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """Plain merging of a short string: again and again the pair of lowest rank, leftmost first; also the last pair."""
        last = None
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.pair_rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [last[0] + last[1]]
        return parts, last

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at one edge of a token while it is merged, and the rank that ends each."""
        key = token, side
        out = self._spines.get(key)
        if out is None:
            out, end = [], float("inf")
            t = token
            while True:
                out.append((t, end))
                if t not in self.split:
                    break
                end = self.pair_rank(*self.split[t])
                t = self.split[t][side]
            out = self._spines[key] = out[::-1]
        return out

    def neighbours(self, a: int, b: int) -> bool:
        key = a << 32 | b
        ok = self._pairs.get(key)
        if ok is None:
            if len(self._pairs) >= MEMO_PAIRS:
                self._pairs.clear()
            left, right = self._spine(self.tokens[a], 1), self._spine(self.tokens[b], 0)
            i, j, ok = 0, 0, True
            while True:  # the two edges in the order in which merging changes them
                (x, x_end), (y, y_end) = left[i], right[j]
                r = self.pair_rank(x, y)
                if r is not None and r < x_end and r <= y_end:
                    ok = False
                    break
                if x_end <= y_end:
                    i += 1
                    if i == len(left):
                        break
                else:
                    j += 1
            self._pairs[key] = ok
        return ok


class Transducer:
    """Encoder for one pre-token as a finite-state transducer whose states are made when first met.

    A state is the set of positions from which a token can still be running: for each, its node in
    the token trie, the token before it, and the tokens decided up to it that are not yet sent. A
    token is sent once all running positions agree on it, which is at most one token length behind.
    """

    def __init__(self, merges: Merges, most: int = MEMO_STATES):
        self.m, self.most = merges, most
        self._reset()

    def _reset(self) -> None:
        self.number = {((0, -1, ()),): 0}
        self.states = [((0, -1, ()),)]
        self.step: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state << 8 | byte
        self.last: list[tuple[int, ...] | None] = [()]

    def _make(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        m = self.m
        trie, final, neighbours = m.trie, m.final, m.neighbours
        alive, here = [], None
        for node, before, pending in self.states[state]:
            node = trie[node].get(byte)
            if node is None:
                continue
            if here is None:
                token = final[node]
                if token >= 0 and (before < 0 or neighbours(before, token)):
                    here = (0, token, (*pending, token))
            if trie[node]:
                alive.append((node, before, pending))
        if here is None:
            raise ValueError("the vocabulary lacks single bytes")
        alive.append(here)
        paths = [x[2] for x in alive]
        low, high, sent = min(paths), max(paths), 0  # what these two share, all share
        while sent < len(low) and low[sent] == high[sent]:
            sent += 1
        first = low[:sent]
        key = tuple([(n, b, p[sent:]) for n, b, p in alive]) if sent else tuple(alive)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.last.append(here[2][sent:])
        out = self.step[state << 8 | byte] = (to, first)
        return out

    def encode(self, piece: bytes) -> tuple[int, ...]:
        if piece in self.m.ids:
            return (self.m.ids[piece],)
        if len(self.states) > self.most:
            self._reset()
        state, out, step = 0, [], self.step
        for b in piece:
            hit = step.get(state << 8 | b) or self._make(state, b)
            state = hit[0]
            if hit[1]:
                out.extend(hit[1])
        out.extend(self.last[state])
        return tuple(out)


class Encoder(dict):
    """Pre-token to its ids; filled on demand, forgotten at MEMO_WORDS entries."""

    def __init__(self, merges: Merges, pattern: str):
        super().__init__()
        self.fst, self.find = Transducer(merges), regex.compile(pattern).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.fst.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for ids in map(self.__getitem__, self.find(text)):
            out += ids
        return out


#: UTF-8 automaton: bytes needed after a lead byte, and the range of the first of them.
def _lead(b: int) -> tuple[int, int, int]:
    if b < 0x80:
        return 0, 0, 0
    if 0xC2 <= b <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= b <= 0xEF:
        return 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
    if 0xF0 <= b <= 0xF4:
        return 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
    return -1, 0, 0


class StreamDecoder:
    """Ids to text, piece by piece: text is given out as soon as its bytes form whole code points.

    The state between calls is (open bytes); bytes that cannot become valid are replaced by U+FFFD,
    one for each maximal broken part, as Python's decoder does.
    """

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.open = tokens, b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.open + b"".join([self.tokens[i] for i in ids])
        keep = 0
        for back in range(1, min(3, len(data)) + 1):  # does the end hold a code point's beginning?
            need, low, high = _lead(data[-back])
            if need > 0:
                if need >= back and (back < 2 or low <= data[-back + 1] <= high):
                    keep = back
                break
            if need == 0 or not 0x80 <= data[-back] <= 0xBF:
                break
        self.open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        data, self.open = self.open, b""
        return data.decode("utf-8", "replace")


class PrefixCounter(dict):
    """Pre-token to the exact number of tokens of each of its code-point prefixes (by prefix dynamic programming)."""

    def __init__(self, merges: Merges, pattern: str):
        super().__init__()
        self.m, self.find = merges, regex.compile(pattern).findall

    def table(self, data: bytes) -> list[int]:
        """Tokens of data[:i] for every i."""
        m, trie, final = self.m, self.m.trie, self.m.final
        n = len(data)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            node, before = 0, last[i]
            if i and before < 0:
                raise ValueError("the vocabulary lacks single bytes")
            for j in range(i, n):
                node = trie[node].get(data[j])
                if node is None:
                    break
                token = final[node]
                if token >= 0 and last[j + 1] < 0 and (before < 0 or m.neighbours(before, token)):
                    last[j + 1], count[j + 1] = token, count[i] + 1
        return count

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        count = self.table(data)
        if len(piece) == len(data):
            out = count[1:]
        else:
            ends, at = [], 0
            for c in piece:
                at += len(c.encode())
                ends.append(count[at])
            out = ends
        if piece[0] == "'" and 1 < len(piece) <= 3 and piece[1:].isalpha():  # the beginnings of a contraction split otherwise
            out = [*(sum(self[x][-1] for x in self.find(piece[:k])) for k in range(1, len(piece))), out[-1]]
        out = tuple(out)
        if len(piece) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[piece] = out
        return out

    def prefixes(self, text: str) -> list[int]:
        """Tokens of text[:1], text[:2], ..., each exactly as if the prefix were encoded alone."""
        out: list[int] = []
        base = before = 0
        blank = ""
        for piece in self.find(text):
            mine = self[piece]
            at = len(out)
            out.extend([base + c for c in mine])
            if blank and piece[0].isspace():  # cut behind one more blank, the run of blanks is one piece
                out[at] = before + self[blank + piece[0]][-1]
            blank, before = (piece if piece.isspace() else ""), base
            base += mine[-1]
        return out
