"""Vectorised pre-tokenisation for byte-level BPE: no regular expression runs over the texts.

The pattern ``public_tokenizers.PATTERN`` is a finite automaton once each character is replaced by a
symbol that already knows the next character or two (is this the last space before a word? does a
contraction follow this apostrophe?). A symbol is a function from state to state, functions compose
associatively, and the functions that arise form a small closed set. So the state before each character is a
prefix scan over that set: inside blocks of a fixed width, then over the blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken

LETTER, NUMBER, OTHER, SPACE, BLANK, EDGE = range(6)
# Symbols: the classes, with apostrophes and white space told apart by what follows.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_BODY, S_SPACE, S_BLANK, S_EDGE = range(9)
# States: what the character before belongs to.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BODY, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8
WIDTH = 64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point, as the regex engine of the tokenizer library sees it."""
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    text = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        engine = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(engine.encode_ordinary(text)).decode("utf-8")
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    out[ord(" ")] = SPACE
    return out


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """Next state, and whether a token starts at this character."""
    if symbol == S_EDGE:
        return FRESH, True
    if symbol == S_BODY:
        return IN_BODY, state != IN_BODY
    if symbol == S_SPACE:
        return AFTER_SPACE, True
    if symbol == S_BLANK:
        return FRESH, True
    if symbol == S_LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (FRESH if state == ONE_LEFT else ONE_LEFT), False
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    goes_on = state in (run, AFTER_SPACE)
    if symbol in (S_SHORT, S_LONG) and not goes_on:
        return (ONE_LEFT if symbol == S_SHORT else TWO_LEFT), True
    return run, not goes_on


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Of the closed set of functions: number of each symbol's, products, values at FRESH; starts; the identity."""
    symbols = [tuple(_step(s, q)[0] for q in range(STATES)) for s in range(9)]
    known = {tuple(range(STATES)): 0}
    todo = [tuple(range(STATES))]
    for f in todo:
        for g in symbols:
            h = tuple(g[q] for q in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    n = len(known)
    product = np.array([[known[tuple(g[q] for q in f)] for g in todo] for f in todo], np.int16).reshape(-1)
    number = np.array([known[s] for s in symbols], np.int16)
    at_fresh = np.array([f[FRESH] for f in todo], np.int16)
    starts = np.array([[_step(s, q)[1] for q in range(STATES)] for s in range(9)], bool).reshape(-1)
    return number, product, at_fresh, starts, n


def _scan(functions: np.ndarray) -> np.ndarray:
    """Product of all functions before each place."""
    _, product, _, _, n = _functions()
    size = len(functions)
    if size == 0:
        return functions
    rows = -(-size // WIDTH)
    padded = np.zeros(rows * WIDTH, np.int16)
    padded[:size] = functions
    block = np.ascontiguousarray(padded.reshape(rows, WIDTH).T)
    before = np.empty_like(block)
    so_far = np.zeros(rows, np.int16)
    for t in range(WIDTH):
        before[t] = so_far
        so_far = product[so_far * n + block[t]]
    if rows > 1:
        carried = _scan(so_far)
        before = product[carried[None, :] * n + before]
    return np.ascontiguousarray(before.T).reshape(-1)[:size]


def token_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(joined texts, starts of the pre-tokens in code points, first pre-token of each text and past the last).

    Texts are joined with one separating character behind each; that character is the last entry of its text
    and is no token. So the tokens of text i are ``starts[first[i]] ... starts[first[i + 1] - 1]``, the last of
    these being the separator.
    """
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind[ends] = EDGE
    white = kind >= SPACE
    last = np.empty(len(white), bool)
    last[:-1] = ~white[1:]
    last[-1] = False
    symbol = np.array([S_LETTER, S_NUMBER, S_OTHER, S_BODY, S_BODY, S_EDGE], np.uint8)[kind]
    symbol[last & (kind == SPACE)] = S_SPACE
    symbol[last & (kind == BLANK)] = S_BLANK
    quote = np.flatnonzero(points == ord("'"))
    if len(quote):
        quote = quote[quote < len(points) - 2]
        one, two = points[quote + 1], points[quote + 2]
        short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        symbol[quote[short]] = S_SHORT
        symbol[quote[long]] = S_LONG
    number, _, at_fresh, starts, _ = _functions()
    state = at_fresh[_scan(number[symbol])]
    found = np.flatnonzero(starts[symbol.astype(np.int16) * STATES + state])
    first = np.zeros(len(texts) + 1, np.int64)
    first[1:] = np.searchsorted(found, ends) + 1
    return joined, found, first


def tokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of all texts, and for each text the first of its tokens; each text ends with one separator."""
    joined, starts, first = token_starts(texts)
    at = starts.tolist()
    at.append(len(joined))
    return [joined[a:b] for a, b in zip(at, at[1:], strict=False)], first

