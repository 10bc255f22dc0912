"""Members cut out of JSON text by their byte ranges, so that what stays keeps its spelling."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_QUOTE, _ESCAPE, _COMMA, _COLON = (ord(c) for c in '"\\,:')


def _row_state(steps: np.ndarray, row_starts: np.ndarray, of_row: np.ndarray) -> np.ndarray:
    """Running sums of ``steps`` that begin anew in every row."""
    running = np.concatenate([[0], np.cumsum(steps)])
    return running[1:] - np.repeat(running[row_starts], np.diff(np.append(row_starts, len(steps))))


def _escaped(raw: np.ndarray) -> np.ndarray:
    """Which bytes follow an odd run of backslashes."""
    escaped = np.zeros(len(raw), bool)
    slashes = np.flatnonzero(raw == _ESCAPE)
    if len(slashes):
        begins = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)  # of runs
        run = np.repeat(slashes[begins], np.diff(np.append(begins, len(slashes))))
        after = slashes[(slashes - run) % 2 == 0] + 1
        escaped[after[after < len(raw)]] = True
    return escaped


def cut_members(bodies: pd.Series, names: tuple[str, ...]) -> pd.Series:
    """JSON objects without their top-level members of the given names, all other bytes as they were.

    Nulls stay null.  Each text must begin with a valid object; one followed by an unfinished object is null.  A name is compared as it reads, so an escaped spelling
    counts too; a member that repeats goes each time.  Blanks before the first member that is kept go with what
    was cut in front of it.
    """
    texts = pa.array(bodies, pa.large_string())
    filled = texts.fill_null("")
    sizes = pc.binary_length(filled).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return bodies
    starts = ends - sizes
    first = int(np.frombuffer(filled.buffers()[1], np.int64)[filled.offset])
    raw = np.frombuffer(filled.buffers()[2], np.uint8)[first : first + int(ends[-1])]
    of_row = np.repeat(np.arange(len(sizes)), sizes)

    quote = (raw == _QUOTE) & ~_escaped(raw)
    inside = _row_state(quote, starts, of_row) % 2 == 1  # from an opening quote up to its closing one
    outside = ~inside & ~quote
    opening, closing = outside & ((raw == ord("{")) | (raw == ord("["))), outside & ((raw == ord("}")) | (raw == ord("]")))
    depth = _row_state(opening.astype(np.int64) - closing, starts, of_row)

    top = outside & (depth == 1)
    begins = np.flatnonzero((opening & (depth == 1)) | (top & (raw == _COMMA)))  # each leads one member
    stops = np.flatnonzero((top & (raw == _COMMA)) | (closing & (depth == 0)))
    rows = len(sizes)
    whole = np.bincount(of_row[begins], minlength=rows) == np.bincount(of_row[stops], minlength=rows)
    begins, stops = begins[whole[of_row[begins]]], stops[whole[of_row[stops]]]
    colons = np.flatnonzero(top & (raw == _COLON))
    colons = colons[whole[of_row[colons]]]
    quotes = np.flatnonzero(quote)
    member = np.searchsorted(begins, colons) - 1  # an empty object has no colon and no member
    key_begins = quotes[np.searchsorted(quotes, begins[member])] + 1
    key_ends = quotes[np.searchsorted(quotes, colons) - 1]

    wanted = {name.encode() for name in names}
    lengths, spelled = key_ends - key_begins, np.concatenate([[0], np.cumsum(raw == _ESCAPE)])
    plain = spelled[key_ends] == spelled[key_begins]
    gone = np.zeros(len(begins), bool)
    for name in wanted:
        alike = np.flatnonzero(plain & (lengths == len(name)))
        letters = raw[key_begins[alike][:, None] + np.arange(len(name))]
        gone[member[alike[(letters == np.frombuffer(name, np.uint8)).all(axis=1)]]] = True
    read: dict[bytes, bool] = {}  # of each escaped spelling, whether it is one of the names
    for at in np.flatnonzero(~plain):
        key = raw[key_begins[at] : key_ends[at]].tobytes()
        if key not in read:
            read[key] = json.loads(b'"' + key + b'"', strict=False).encode("utf-8", "surrogatepass") in wanted
        gone[member[at]] = read[key]

    row = of_row[begins]
    kept_before = _row_state(~gone, np.searchsorted(row, np.arange(rows)), row) - ~gone
    orphan = ~gone & (kept_before == 0) & (raw[begins] == _COMMA)  # its comma has nothing left before it
    opens = raw[begins] != _COMMA
    change = np.bincount(begins[gone] + opens[gone], minlength=len(raw) + 1) - np.bincount(stops[gone], minlength=len(raw) + 1)
    keep = np.cumsum(change)[:-1] == 0
    keep[begins[orphan]] = False
    left = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.append(left[starts], left[-1])
    data = raw[keep].tobytes()
    out = pa.Array.from_buffers(
        pa.large_string(), rows, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)]
    )
    lost = texts.is_null().to_numpy(zero_copy_only=False) | ~whole
    return pd.Series(np.where(lost, None, np.array(out.to_pylist(), dtype=object)))
