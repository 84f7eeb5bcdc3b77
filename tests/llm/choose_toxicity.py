"""Choose SCALE and RATE of the toxicity model by cross-validation: python tests/llm/choose_toxicity.py [table folder].

Only rows whose crc32(doc_id as text) mod 4 is not 2 are read; they are dealt to three folds by another hash.
Prints log loss, area under the curve, recall and precision at the threshold for each pair of values.
"""

import sys
import zlib
from multiprocessing import Pool
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from lakeforge.llm import toxicity  # noqa: E402

SCALES, RATES, FOLDS = (30.0, 100.0, 300.0), (0.1, 0.3, 1.0), 3


def rows(folder: str):
    labels = {d: t for d, t in zip(*pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "toxic"]).to_pydict().values(), strict=True)}
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    found = [(d, t, labels[d]) for d, t in zip(docs["doc_id"], docs["text"], strict=True) if d is not None and labels.get(d) in (0, 1) and zlib.crc32(str(d).encode()) % 4 != 2]
    return [toxicity.bag(t or "") for _, t, _ in found], np.array([y for _, _, y in found]), np.array([zlib.crc32(f"fold{d}".encode()) % FOLDS for d, _, _ in found])


def scores(model, bags):
    weights, bias = model
    z = np.array([bias + float(weights[i] @ n) / max(float(n.sum()), 1) for i, n in bags])
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def auc(y, p):
    rank = np.empty(len(p))
    rank[np.argsort(p, kind="stable")] = np.arange(1, len(p) + 1)
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / max((y == 1).sum() * (y == 0).sum(), 1)


def tried(job):
    scale, rate, folder = job
    toxicity.SCALE, toxicity.RATE = scale, rate
    bags, y, fold = rows(folder)
    p = np.zeros(len(y))
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        model = toxicity.fit(toxicity.Bags([bags[i] for i in inside]), y[inside])
        p[fold == k] = scores(model, [bags[i] for i in np.flatnonzero(fold == k)])
    hit = p >= toxicity.THRESHOLD
    loss = -np.mean(np.where(y == 1, np.log(np.clip(p, 1e-9, 1)), np.log(np.clip(1 - p, 1e-9, 1))))
    return scale, rate, len(y), loss, auc(y, p), hit[y == 1].mean(), y[hit].mean() if hit.any() else 0.0


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    with Pool(8) as pool:
        for r in pool.imap(tried, [(s, r, folder) for s in SCALES for r in RATES]):
            print("scale %g rate %g rows %d: log loss %.4f, AUC %.4f, recall %.3f, precision %.3f" % r, flush=True)
