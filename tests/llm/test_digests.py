import hashlib

import pytest
from cases import SF, ascii_lower, awkward, documents, frame, multiset, rows_of
from loomwire.llm import digest_tree
from loomwire.llm.queries import op2_digest_tree


def plain(cases):
    groups = {}
    for d, t in cases:
        groups.setdefault(ascii_lower(t or ""), []).append(d)
    out = []
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        first = True
        for d in sorted(ids, key=lambda d: (d is None, d)):
            kept = d == keep and first
            first = first and not kept
            out.append({"doc_id": d, "keep_id": keep, "group_size": len(ids), "kept": kept,
                        "text_sha256": hashlib.sha256(text.encode()).hexdigest()})
    return out


def test_all_documents(spark):
    assert multiset(rows_of(op2_digest_tree(spark, SF))) == multiset(plain(documents().items()))


@pytest.mark.parametrize("partitions,fan_in", [(1, 8), (7, 2), (20, 4)])
def test_awkward_documents(spark, partitions, fan_in):
    cases = awkward() * 3
    docs = frame(spark, cases).repartition(partitions)
    assert multiset(rows_of(digest_tree.duplicates(docs, fan_in=fan_in))) == multiset(plain(cases))


def test_smallest_and_empty(spark):
    cases = [(3, "a"), (1, "A"), (2, "b")]
    rows = {r["doc_id"]: r for r in rows_of(digest_tree.duplicates(frame(spark, cases), best="smallest"))}
    assert rows[3]["keep_id"] == 1 and rows[1]["kept"] and not rows[3]["kept"] and rows[2]["group_size"] == 1
    assert digest_tree.duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        digest_tree.duplicates(frame(spark, cases), fan_in=3)
