import re

import cases
import xxhash
from corpusloom.functions.frames import materialize
from corpusloom.llm.components import components
from corpusloom.llm.simhash_dedup import drop_near_duplicates, links, near_duplicates


def _print(text: str | None, width: int) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _expected(rows: list[tuple], width: int, bits: int) -> list[tuple]:
    prints = [_print(t, width) for _, t, _ in rows]
    group = list(range(len(rows)))

    def top(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                group[top(i)] = top(j)
    names: dict[int, int] = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            names[top(i)] = min(names.get(top(i), doc_id), doc_id)
    return [(doc_id, f"{p:016x}", names.get(top(i))) for i, ((doc_id, _, _), p) in enumerate(zip(rows, prints, strict=True))]


def _got(df) -> list[tuple]:
    return [(r.doc_id, f"{r.fingerprint & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()]


def test_equals_all_pairs(spark):
    rows = cases.texts()
    assert sorted(_got(near_duplicates(cases.table(spark))), key=repr) == sorted(_expected(rows, 3, 2), key=repr)
    for bits in (0, 4):
        assert sorted(_got(near_duplicates(cases.table(spark), 2, bits)), key=repr) == sorted(_expected(rows, 2, bits), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert sorted(_got(near_duplicates(docs))) == sorted(_expected(rows, 3, 2))


def test_one_stays(spark):
    rows = [r for r in cases.texts() if r[1] != "other text below an id that is taken"]  # else two groups have one name
    kept = drop_near_duplicates(cases.table(spark, rows)).collect()
    groups = {(d, t): c for (d, t, _), (_, _, c) in zip(rows, _expected(rows, 3, 2), strict=True)}
    names = [groups[r.doc_id, r.text] for r in kept]
    assert len(names) == len(set(names)) and set(names) == set(groups.values())
    assert all(r.doc_id == c for r, c in zip(kept, names, strict=True)) and kept[0].asDict().keys() == cases.table(spark).collect()[0].asDict().keys()


def test_empty_and_null(spark):
    assert near_duplicates(cases.table(spark, [])).collect() == []
    assert drop_near_duplicates(cases.table(spark, [])).collect() == []
    assert _got(near_duplicates(cases.with_nulls(spark))) == [(None, "0" * 16, None)] * 3
    assert len(drop_near_duplicates(cases.with_nulls(spark)).collect()) == 1


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(500)] + [(i + 1, i) for i in range(500)] + [(1000, 1001), (7, 7), (9000, 9000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(501)} | {1000: 1000, 1001: 1000}


def test_postings_are_not_broadcast(spark):
    prints = materialize(spark.range(1000).selectExpr("xxhash64(id) AS fingerprint"), "prints")
    near = prints.union(prints.selectExpr("fingerprint ^ 3"))
    plan = links(near, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert links(near, 2).count() == 1000
