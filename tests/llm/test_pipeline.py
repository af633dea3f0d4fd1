"""The whole pipeline against its stages by brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from termtide.llm import private

from .conftest import SCHEMA
from .test_texts import WORD, classes_by_brute_force, crc, filled_up, ids_of, plain_spans


def without_copies(rows):
    """The row that names its class, once, of each class."""
    classes = dict(classes_by_brute_force(rows))
    return list({r[0]: r for r in rows if classes[r[0]] == r[0]}.values())


def without_private(rows, model):
    """Spans of the fixed patterns and of the field, character by character."""
    out = []
    for r in rows:
        text = r[1] or ""
        base = plain_spans(text)
        spans = model.spans([text], [base])[0]
        assert set(base) <= set(spans)
        mark, end = {}, 0
        for a, b, kind in spans:
            if a >= end:
                mark[a] = f"<{kind}>"
            end = max(end, b)
        hidden = {i for a, b, _ in spans for i in range(a, b)}
        new = "".join(mark.get(i, "") + ("" if i in hidden else c) for i, c in enumerate(text))
        out.append((r[0], new, *r[2:]))
    return out


def mixed_by_brute_force(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sources = defaultdict(list)
    for r in rows:
        name = "null" if r[0] is None else str(r[0])
        sources[r[3]].append((hashlib.md5(f"mix:{name}".encode()).hexdigest()[:13], r, size(r[1])))
    totals = {s: sum(x[2] for x in members) for s, members in sources.items()}
    targets = filled_up(totals)
    out = []
    for source, members in sources.items():
        epochs, left = divmod(int(targets[source]), max(1, totals[source]))
        for _, r, n in sorted(members, key=lambda x: x[0]):
            taken = epochs * n + max(0, min(n, left))
            left -= n
            out += [r] * (int(taken / n + 0.5) if n else 1)
    return out


def test_pipeline_by_brute_force(spark, odd, odd_rows, tmp_path):
    import corpus_pipeline

    odd.write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    rows = [r for r in odd_rows if any(c.isalpha() for c in r[1] or "")]
    assert len(rows) < len(odd_rows)
    rows = without_copies(rows)
    rows = without_private(rows, private.learn(spark.createDataFrame(rows, SCHEMA)))
    rows = mixed_by_brute_force(rows)
    want = Counter()
    for r in rows:
        ids = [*ids_of(WORD, r[1]), 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            want[r[0], k, a, len(part), crc(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want

    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in found) // 4096) + 1


def test_pipeline_without_labels_keeps_its_documents(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, "one text of some words", None, "a", 22), (2, "другой текст", None, "a", 12), (3, "12 !", None, "a", 4), (4, None, None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 2}
