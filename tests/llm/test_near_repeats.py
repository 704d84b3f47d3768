"""Rows that repeat with the same id and text are one node of the near-duplicate search."""

from llm.conftest_llm import BASE

from wattlake.llm import neardup


def test_repeated_rows_make_one_set_and_one_link(spark, docs_of, monkeypatch):
    kept, real = {}, neardup.written

    def noted(frame, label):
        kept[label] = real(frame, label)
        return kept[label]

    monkeypatch.setattr(neardup, "written", noted)
    words = [w + str(k) for k in range(8) for w in BASE]
    one, two = " ".join(words), " ".join([*words, "end"])
    rows = [(None, one, "a")] * 200 + [(None, two, "a")] * 200 + [(7, one, "b")] * 50 + [(9, "alone " + one[:20], "b")]
    got = neardup.near_groups(docs_of(rows)).collect()
    assert kept["shingle-sets"].count() == 2 and kept["near-links"].count() == 1
    assert len(got) == len(rows) and {r.component_id for r in got if r.doc_id != 9} == {7}
    assert sum(r.stays for r in got) == 2
