"""Per-document statistics of whole texts, vectorised over the rows of a chunk."""

from __future__ import annotations

import numpy as np

from .common import SPACE, Words, distinct, mix, prefix_hashes, span_hashes

#: Byte classes: upper, lower, digit, symbol, stop, comma, loud, quote, other ASCII, space, newline, lead byte, continuation.
UPPER, LOWER, DIGIT, SYMBOL, STOP, COMMA, LOUD, QUOTE, OTHER, BLANK, LINE, LEAD, MORE = range(13)
CLASSES = 13
CLASS = np.full(256, OTHER, np.int64)
CLASS[0x41:0x5B], CLASS[0x61:0x7B], CLASS[0x30:0x3A] = UPPER, LOWER, DIGIT
CLASS[list(b"#*$%&|<>")] = SYMBOL
CLASS[list(b".")], CLASS[list(b",;:")], CLASS[list(b"!?")], CLASS[list(b"\"'")] = STOP, COMMA, LOUD, QUOTE
CLASS[SPACE] = BLANK
CLASS[0x0A] = LINE
CLASS[0x80:0xC0], CLASS[0xC0:] = MORE, LEAD


def _keyed(h: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows; not symmetric in its arguments, as short words hash to what small numbers mix to."""
    return mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + salt)


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    s = np.sort(keys)
    twice = distinct(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def _per_row(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def statistics(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per row; classes is a matrix of the byte classes."""
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    w, prefix = Words(data, bounds, hashed=False), prefix_hashes(data)
    word = mix(span_hashes(prefix, w.start, w.end))  # of the words as written
    nw = np.diff(w.first)
    code = np.where((data & 0xC0) != 0x80, w.solid, False)
    out = {"classes": np.bincount(row * CLASSES + CLASS[data], minlength=rows * CLASSES).reshape(rows, CLASSES), "n_words": nw, "word_chars": np.bincount(row[code], minlength=rows)}
    out["n_symbols"] = out["classes"][:, SYMBOL]

    word_row = np.repeat(np.arange(rows), nw)
    salt = mix(mix(np.arange(rows, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
    covered = np.zeros(len(word) + 1, np.int64)
    if len(word) >= 5:
        g = word[: len(word) - 4].copy()
        for k in range(1, 5):
            g = mix(g * np.uint64(0xD6E8FEB86659FD93) + word[k : len(word) - 4 + k])
        at = np.flatnonzero(word_row[:-4] == word_row[4:])
        at = at[_repeats(_keyed(g[at], salt[word_row[at]]))]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 5, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(covered)[:-1] > 0, w.first)
    keyed = _keyed(word, salt[word_row])
    out["n_distinct"] = _distinct(keyed, word_row, rows)

    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    # An empty last line starts where the next row does: starts are dealt to rows by count.
    per = np.bincount(row[breaks], minlength=rows) + 1
    line_row = np.repeat(np.arange(rows), per)
    first = np.concatenate([[0], np.cumsum(per)])
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    end[first[1:] - 1] = bounds[1:]
    solid = np.concatenate([[0], np.cumsum(w.solid)])
    full = solid[np.maximum(end, start)] > solid[start]
    h = mix(span_hashes(prefix, start, np.maximum(end, start)) + (end - start).astype(np.uint64))
    h = _keyed(h, salt[line_row])[full]
    lr = line_row[full]
    out["n_lines"] = np.bincount(lr, minlength=rows)
    out["n_dup_lines"] = out["n_lines"] - _distinct(h, lr, rows)
    size = (w.end - w.start).astype(np.float64)
    out["long_words"] = np.bincount(word_row[size > 12], minlength=rows)
    out["short_words"] = np.bincount(word_row[size <= 3], minlength=rows)
    out["squares"] = np.bincount(word_row, size * size, minlength=rows)
    out["bytes_in_words"] = np.bincount(word_row, size, minlength=rows)
    capital = CLASS[data[w.start]] == UPPER if len(w.start) else np.zeros(0, bool)
    out["capitals"] = np.bincount(word_row[capital], minlength=rows)
    tail = CLASS[data[w.end - 1]] if len(w.end) else np.zeros(0, np.int64)
    for name, kind in (("end_symbol", SYMBOL), ("end_loud", LOUD), ("end_stop", STOP)):
        out[name] = np.bincount(word_row[tail == kind], minlength=rows)
    return out


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys per row, for keys that rows don't share (they are salted by row)."""
    order = np.argsort(keys)
    k = keys[order]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    return np.bincount(row[order][new], minlength=rows)


FEATURES = ("log_words", "upper", "digit", "symbol", "stop", "comma", "loud", "other", "newline", "lead", "distinct", "repeat", "dup_lines", "word_len", "word_var", "long", "short", "capitals", "end_symbol", "end_loud", "end_stop", "line_words")


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, one row per document: logs of sizes, and square roots of shares (which evens their variance)."""
    c = s["classes"].astype(np.float64)
    n = np.maximum(c.sum(axis=1) - c[:, MORE], 1)
    w = np.maximum(s["n_words"], 1).astype(np.float64)
    root = lambda x, of: np.sqrt(np.clip(x / of, 0, None))
    mean = s["bytes_in_words"] / w
    return np.column_stack([
        np.log1p(s["n_words"]), root(c[:, UPPER], n), root(c[:, DIGIT], n), root(c[:, SYMBOL], n), root(c[:, STOP], n), root(c[:, COMMA], n), root(c[:, LOUD], n), root(c[:, OTHER] + c[:, QUOTE], n), root(c[:, LINE], n), root(c[:, LEAD], n),
        s["n_distinct"] / w, root(s["n_repeat_words"], w), root(s["n_dup_lines"], np.maximum(s["n_lines"], 1)), np.log1p(mean), np.log1p(np.maximum(s["squares"] / w - mean * mean, 0)), root(s["long_words"], w), root(s["short_words"], w), root(s["capitals"], w),
        root(s["end_symbol"], w), root(s["end_loud"], w), root(s["end_stop"], w), np.log1p(w / np.maximum(s["n_lines"], 1)),
    ])
