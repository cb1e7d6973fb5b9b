"""The matches of the byte-level pattern in whole columns of text, by runs of character classes.

Method. The pattern's alternatives are runs of one class (letters, numbers, other characters,
white space), so its matches follow from where classes change. Every byte of a column has the
class of its character, from a table over all code points; comparing neighbours gives the
starts of runs, and three rules give the matches:

- a space right before a run of another class belongs to that run;
- a run of white space before other text leaves its last character to what follows, as a
  match of its own unless it is a space; at the end of a text it is one match;
- an apostrophe that is a run by itself and not led by a space takes s, t, m, d, re, ve or ll
  that follow it.

No match spans two rows. The classes are those of the splitting library's own tables, asked
once for each worker.
"""

from __future__ import annotations

import numpy as np

#: the pattern these rules are for; a fixed value
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_POINTS = 0x110000


def _every_point() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, _POINTS)]))


def _table(runs) -> np.ndarray:
    """Classes of all code points; runs(kind) gives the (first, last + 1) places of a class in _every_point()."""
    out = np.zeros(_POINTS - 0x800, np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        for a, b in runs(name):
            out[a:b] = kind
    return np.concatenate([out[:0xD800], np.zeros(0x800, np.uint8), out[0xD800:]])


def library_classes() -> np.ndarray:
    """The classes that the tokenizers library has."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    every = _every_point()
    return _table(lambda name: [at for _, at in Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(every)])


def regex_classes() -> np.ndarray:
    """The classes of the regex module, whose white space is the Unicode property."""
    import regex

    every = _every_point()
    return _table(lambda name: [m.span() for m in regex.finditer(name.replace(r"\s", r"\p{White_Space}") + "+", every)])


def tiktoken_classes() -> np.ndarray:
    """The classes that the tiktoken library has: what a pattern of one class leaves of all code points."""
    import tiktoken

    every = _every_point()
    points = np.frombuffer(every.encode("utf-32-le"), np.uint32)

    def runs(name):
        own = tiktoken.Encoding("own", pat_str=f"{name}+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        left = np.frombuffer(bytes(own.encode_ordinary(every)).decode().encode("utf-32-le"), np.uint32)
        at = np.searchsorted(points, left)
        cuts = np.flatnonzero(np.diff(at) != 1) + 1
        return zip(at[np.append(0, cuts)], at[np.append(cuts, len(at)) - 1] + 1, strict=True)

    return _table(runs)


def byte_classes(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of each byte's character."""
    out = table[:256][buf]
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        first = buf[lead]
        point = np.zeros(len(lead), np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0).astype(np.int64)
        for n, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
            some = size == n
            at = lead[some]
            value = (first[some] & mask).astype(np.int64)
            for k in range(1, n):
                value = (value << 6) | (buf[at + k] & 0x3F)
            point[some] = value
        kind = table[point]
        out[lead] = kind
        for k in (1, 2, 3):
            some = size > k
            out[lead[some] + k] = kind[some]
    return out


def matches(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The first byte of every match, in order; buf holds valid UTF-8 and offs the bounds of the rows."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    kind = byte_classes(buf, table)
    row = np.zeros(n + 1, bool)
    row[offs] = True
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change |= row
    start = change[:n].copy()
    blank = kind == SPACE
    # the last character of white space before other text in its row
    ends = np.flatnonzero(blank & change[1:] & ~row[1:])
    first = ends
    for _ in range(3):  # back to its first byte
        first = np.where((buf[first] & 0xC0) == 0x80, first - 1, first)
    start[first] = True
    # a space goes to what follows
    start[ends[buf[ends] == 0x20] + 1] = False
    # contractions
    mark = np.flatnonzero((buf == 0x27) & start)
    if len(mark):
        mark = mark[(mark + 1 < n)]
        mark = mark[change[mark + 1] & ~row[mark + 1]]
        a = buf[mark + 1]
        b = np.where(mark + 2 < n, buf[np.minimum(mark + 2, n - 1)], 0)
        b[row[np.minimum(mark + 2, n)]] = 0
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        start[mark[one | two] + 1] = False
        for some, size in ((mark[one], 2), (mark[two], 3)):
            cut = some + size
            cut = cut[cut < n]
            start[cut] = True
    return np.flatnonzero(start)


def gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[first[i] : first[i] + sizes[i]] of every i, joined, and where each ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat((first - (ends - sizes)).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return flat.take(at), ends
