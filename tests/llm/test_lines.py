from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from carelayers.llm import lines
from helpers import document_table


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc, text, _, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if line and text is not None:
                if site is not None:
                    sites[line].add(site)
                # As Spark orders: no id first.
                place = (doc is not None, doc or 0, pos)
                first[line] = min(first.get(line, place), place)
    lost = defaultdict(set)
    for doc, text, _, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if line and doc is not None and len(sites[line]) >= min_sites and first[line] != (True, doc, pos):
                lost[doc].add(pos)
    out = []
    for doc, text, *_ in rows:
        if text is None or not lost[doc]:
            out.append((doc, text, 0))
        else:
            kept = [x for i, x in enumerate(text.split("\n")) if i not in lost[doc]]
            out.append((doc, "\n".join(kept), len(lost[doc])))
    return sorted(map(str, out))


def run(spark, rows, min_sites, extra=False):
    out = lines.dedup_lines(document_table(spark, rows, extra), min_sites=min_sites)
    return sorted(map(str, map(tuple, out.select("doc_id", "text", "n_removed").collect()))), out


def test_shared_lines_keep_their_first_place(spark):
    rows = [(i, f"own {i}\nshared\nmore {i}\n\nshared", None, f"s{i % 4}") for i in range(12)]
    got, out = run(spark, rows, 4)
    assert got == brute(rows, 4)
    assert sum("shared" in r.text for r in out.collect()) == 1
    assert run(spark, rows, 5)[0] == sorted(str((r[0], r[1], 0)) for r in rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, "a"), (2, "", None, "b"), (3, "x\n\nx", None, None), (None, "x", None, "c"), (4, "x", None, "d"),
        (5, "x\ny", None, "e"), (6, "\nx\n", None, "e"), (7, "line " * 100_000 + "\nx", None, "a"),
        (8, "\n".join(["x"] * 20_000), None, "b"),
    ]
    for extra in (False, True):
        got, out = run(spark, rows, 3, extra)
        assert got == brute(rows, 3)
        assert out.columns.count("n_removed") == 1
    assert lines.dedup_lines(document_table(spark, [])).collect() == []


def test_near_the_threshold_counts_are_exact(spark):
    """Thousands of sites, where sketches are only estimates; counts around the threshold decide."""
    threshold = 3000
    rows = [(i, "below" if i < threshold - 1 else "z", None, f"s{i}") for i in range(threshold)]
    rows += [(10_000 + i, "at", None, f"s{i}") for i in range(threshold)]
    got = lines.dedup_lines(document_table(spark, rows), min_sites=threshold)
    lost = {r.doc_id for r in got.where("n_removed > 0").collect()}
    assert lost == set(range(10_001, 10_000 + threshold))


def test_only_built_in_functions(spark, plan):
    text = plan(lines.dedup_lines(document_table(spark, [(1, "a", None, "s")])))
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["", "a", "b", "c c"]), max_size=5), st.sampled_from("stuv")), max_size=10))
def test_random_tables(spark, drawn):
    rows = [(i, "\n".join(text), None, site) for i, (text, site) in enumerate(drawn)]
    assert run(spark, rows, 2)[0] == brute(rows, 2)


def brute_by_row(rows, min_sites):
    """Each row alone; the first place is an id and a position."""
    sites, first = defaultdict(set), {}
    for doc, text, _, site in rows:
        for pos, line in enumerate(text.split("\n")):
            if line:
                sites[line].add(site)
                first[line] = min(first.get(line, (doc, pos)), (doc, pos))
    out = []
    for doc, text, *_ in rows:
        at = list(enumerate(text.split("\n")))
        kept = [x for i, x in at if not x or len(sites[x]) < min_sites or first[x] == (doc, i)]
        out.append((doc, "\n".join(kept), len(at) - len(kept)))
    return sorted(map(str, out))


def test_rows_that_repeat_an_id_lose_only_shared_lines(spark):
    rows = [(50, "shared\nkeep a", None, "a"), (50, "PRECIOUS LINE\nother", None, "b"), (50, "x\nshared", None, "c")]
    rows += [(60 + i, f"own {i}\nshared", None, f"s{i}") for i in range(5)]
    rows += [(50, "shared\nkeep a", None, "a"), (40, "shared", None, "d"), (40, "shared", None, "e")]
    got, _ = run(spark, rows, 4)
    assert got == brute_by_row(rows, 4)
    assert any("PRECIOUS LINE\\nother" in r for r in got)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.sampled_from(["", "a", "b", "c"]), max_size=5), st.sampled_from("stuv")), max_size=12))
def test_random_tables_with_repeated_ids(spark, drawn):
    """Lines sent to all tasks, and lines joined by a shuffle but for the hottest."""
    rows = [(i, "\n".join(text), None, site) for i, text, site in drawn]
    df = document_table(spark, rows)
    for sent in (lines.SENT_LINES, 1):
        out = lines.dedup_lines(df, min_sites=2, sent=sent).select("doc_id", "text", "n_removed")
        assert sorted(map(str, map(tuple, out.collect()))) == brute_by_row(rows, 2)
