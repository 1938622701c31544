"""op1 as registered, at its width of 400 bytes, against a count of all windows."""

import hashlib
from collections import Counter

from tickweave.llm.queries import QUERIES

DATA, WIDTH = "/root/testdata/sf0.01", 400


def test_removed_bytes_at_full_width(spark):
    raw = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    windows = {i: [hash(b[k : k + WIDTH]) for k in range(len(b) - WIDTH + 1)] for i, b in raw.items()}
    seen = Counter(h for own in windows.values() for h in own)
    want = {}
    for i, b in raw.items():
        spans = []
        for k, h in enumerate(windows[i]):
            if seen[h] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + WIDTH
                else:
                    spans.append([k, k + WIDTH])
        ends = [0, *[x for s in spans for x in s], len(b)]
        kept = b"".join(b[x:y] for x, y in zip(ends[::2], ends[1::2]))
        want[i] = (len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    rows = QUERIES["op1_suffix_array_dedup"](spark, DATA).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and len(rows) == len(raw)
    assert sum(w[1] > 0 for w in want.values()) > 100
