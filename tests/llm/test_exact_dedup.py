import hashlib
import re

from odd_texts import ODD
from tripcast.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[norm], key=lambda x: (x[0], x[1]))[1]
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


def test_groups_match_brute_force(docs_of):
    texts = ODD + ["a b", "ab", " a\tb ", "A b", "same " * 50, "same" * 50]
    rows = list(enumerate(texts))
    got = exact_dedup.duplicate_groups(docs_of(texts, clash=True), digest_all=True).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_refinement_reads_full_content_of_survivors_only(docs_of):
    texts = ["abc", "abd", "abc", "longer text"]
    got = {r["doc_id"]: r for r in exact_dedup.duplicate_groups(docs_of(texts)).collect()}
    assert [got[i]["keep_id"] for i in range(4)] == [0, 1, 0, 3]
    assert got[3]["full_hash"] is None and got[0]["full_hash"] is not None


def test_deduplicate_keeps_columns_and_one_of_repeated_rows(docs_of):
    docs = docs_of([(1, "x y"), (1, "x y"), (2, "xy "), (None, "z"), (None, "z"), (4, None)])
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out.collect()) == [
        (False, 1, "x y"), (False, 4, None), (True, 0, "z")]


def test_rows_of_one_id_are_told_apart(docs_of):
    rows = [(1, "ab"), (1, "a b"), (2, "ab"), (3, "c d"), (3, "cd"), (3, "c  d"), (4, "c  d")]
    docs = docs_of(rows, clash=True)
    kept = exact_dedup.deduplicate(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "a b"), (3, "c  d")]
    got = exact_dedup.duplicate_groups(docs, digest_all=True).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got if r["kept"]) == [(1, 1, 3), (3, 3, 4)]
    assert len(got) == 7


def test_a_hot_group_and_unique_rows_at_one_length(docs_of):
    rows = [(i, "hot text " * 20) for i in range(200)] + [(200 + i, "x" * 64 + f"{i:04d}") for i in range(100)]
    rows += [(300 + i, "x" * 64 + f"{i:04d}" + " ") for i in range(0, 100, 2)]
    got = exact_dedup.duplicate_groups(docs_of(rows), digest_all=True).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    kept = exact_dedup.deduplicate(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({k for _, k, *_ in brute(rows)})


def test_empty_table(docs_of):
    assert exact_dedup.duplicate_groups(docs_of([]), digest_all=True).count() == 0
    assert exact_dedup.deduplicate(docs_of([])).count() == 0
