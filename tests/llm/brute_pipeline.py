"""The pipeline in plain Python, for texts that all have a language."""

from __future__ import annotations

import hashlib

from test_decontamination import brute as brute_items
from test_simhash import brute_code, brute_components


def _without_repeats(rows, size=100):
    seen = set()
    for doc, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i : i + size] in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(data[i : i + size])
        kept = bytes(c for c, g in zip(data, gone) if not g).decode(errors="ignore")
        if kept.strip() or not any(gone):
            yield doc, kept


def run(docs, items):
    parts = brute_components([brute_code(t) for _, t in docs], [d for d, _ in docs])
    rows = [(d, t) for (d, t), part in zip(docs, parts) if d == part]
    rows = list(_without_repeats(rows))
    bad = {pair[0] for pair in brute_items(rows, items)}
    return {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows if d not in bad}
