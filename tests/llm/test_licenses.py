import brute

from satlink.llm import licenses, queries


def test_query(spark, small_dir, docs):
    got = queries.op6_licence_index(spark, small_dir).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute.licences(docs)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_edges_and_other_labels(frame):
    rows = [(1, None), (2, ""), (3, "under the MIT license under the mit license CC-BY-NC cc by nc nd"), (3, "x"), (3, "x"), (4, "Licensed under the GNU General Public License, version 3."), (None, "the mit license"),
            (5, "Apache License, Version 2.0 é under  THE mit licensé apache license version 20"), (6, "gnu general public"), (7, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files")]
    got = {(r.doc_id, r.n_words): r for r in licenses.scan(frame(rows, ["words", "codes", "base"])).collect()}
    begins = lambda key, field="base": [(h.start, h.label) for h in got[key][field]]
    assert begins((3, 15)) == [(0, "mit"), (4, "mit"), (8, "cc-by-nc"), (11, "cc-by-nc")] and begins((3, 15), "found") == [(11, "cc-by-nc-nd")]
    assert {x for _, x in begins((4, 9), "found")} == {"gpl", "gpl-3"} and begins((6, 3), "found") == [] and begins((5, 14)) == [(0, "apache-2")]
    assert begins((1, 0)) == [] and got[(1, 0)].score == 0 and got[(None, 3)].base == []
    assert {x for _, x in begins((7, 20), "found")} == {"mit"}
    assert licenses.scan(frame([])).collect() == []


def test_texts_with_changes_and_their_share(frame):
    """Whole licence texts are found also with some words changed; the score is the IDF share of the words at their places."""
    from satlink.llm.licence_texts import TEXTS

    rows = [(i, f"intro words here {t} and more") for i, (_, _, t) in enumerate(TEXTS)]
    words = TEXTS[0][2].split()
    rows += [(100, " ".join("altered" if i in (10, 40) else w for i, w in enumerate(words))), (101, " ".join(words[:8])), (102, "permission granted of charge hereby free")]
    rows += [(200 + i, "plain words of other kinds") for i in range(40)]
    got = {r.doc_id: r for r in licenses.scan(frame(rows)).collect()}
    for i, (label, mandatory, _) in enumerate(TEXTS):
        assert label in {h.label for h in got[i].found} and got[i].score == 1.0
    assert {h.label for h in got[100].found} >= {"mit"} and 0.8 < got[100].score < 1
    assert got[101].found == [] and 0 < got[101].score < 0.6 and got[102].found == [] and got[200].score == 0


def test_work_grows_with_the_words_not_with_their_square(frame):
    """A text of 72,000 words that repeats phrases, and a hundred more templates."""
    import time

    text = "x under the mit license and apache license version 2 or cc by nc " * 5000
    more = tuple(licenses.Template(f"own-{i}", f"special licence number{i} of the house", f"licence number{i}") for i in range(100))
    times = []
    for templates in (licenses.TEMPLATES, licenses.TEMPLATES, licenses.TEMPLATES + more):
        begin = time.perf_counter()
        row = licenses.scan(frame([(1, text)]), templates).collect()[0]
        times.append(time.perf_counter() - begin)
        assert len(row.base) == 15_000 and row.n_words == 70_000
    assert times[1] < 15 and times[2] < 2 * times[1] + 4
