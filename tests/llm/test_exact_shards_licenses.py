import re
import textwrap
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pyarrow as pa
import pytest
from llm.conftest_llm import ODD

from wattlake.llm import exact, license_scan, shards
from wattlake.llm.licences import END, FILES, ISC, MIT, NAMED, TEXTS, known
from wattlake.llm.survivors import surviving


def lowered(text):
    return (text or "").encode().lower()


def test_exact_groups(odd):
    rows = exact.exact_groups(odd).collect()
    assert len(rows) == len(ODD)
    groups = defaultdict(list)
    for i, text, _ in ODD:
        groups[sha256(lowered(text)).digest()].append(i)
    for row in rows:
        ids = groups[bytes(row.digest)]
        assert row.group_size == len(ids)
        known = [i for i in ids if i is not None]
        assert row.keep_id == (max(known) if known else None)
        assert not row.kept or row.doc_id == row.keep_id
    assert Counter(bytes(r.digest) for r in rows if r.kept) == Counter(groups.keys())


def test_exact_groups_of_nothing(none):
    assert exact.exact_groups(none).count() == 0


@pytest.mark.parametrize("counters", [1, 4])
def test_frequent_groups_give_the_same(docs_of, counters):
    rows = [(i, "Hot" if i % 3 == 0 else f"t{i // 2}", "s") for i in range(300)]
    got = exact.exact_groups(docs_of(rows, 5), counters=counters).collect()
    hot = [r for r in got if r.group_size == 100]
    assert {r.keep_id for r in hot} == {297} and len(hot) == 100
    size = Counter(text for _, text, _ in rows)
    assert Counter(r.group_size for r in got) == Counter(size[t] for _, t, _ in rows)


def test_misra_gries_keeps_what_is_frequent():
    keys = [b"hot"] * 60 + [bytes([i]) for i in range(100)]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[k::4])], names=["digest"]) for k in range(4)]
    kept = pa.Table.from_batches(list(exact.summaries(iter(batches), 3))).to_pydict()
    assert b"hot" in kept["digest"] and len(kept["digest"]) <= 3
    assert dict(zip(kept["digest"], kept["n"]))[b"hot"] <= 60


def test_survivors_keep_columns_and_one_of_repeated_rows(odd):
    left = surviving(odd, exact.exact_groups(odd).where("kept"), "doc_id", "text")
    assert left.columns == odd.columns
    texts = [lowered(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({lowered(t) for _, t, _ in ODD})


def test_shards(odd):
    rows = shards.shard_documents(odd, shards=4).collect()
    assert len(rows) == len(ODD)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(4))
    for k, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(n))
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    raw = [(i, (t or "").encode()) for i, t, _ in ODD]
    assert sizes == Counter((i, len(t) + 1, zlib.crc32(t)) for i, t in raw)
    assert {r.law for r in rows} == {"rows"}


def test_shards_hold_the_mixture(docs_of, monkeypatch):
    monkeypatch.setattr("wattlake.llm.ranks.BUCKET_ROWS", 50)
    rows = [(i, "x", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1000)]
    rows += [(i, "x", f"rare{i}") for i in range(1000, 1040)]
    got = shards.shard_documents(docs_of(rows)).collect()
    total = Counter(s for _, _, s in rows)
    part = Counter((r.shard, r.source) for r in got)
    assert {n for n in Counter(r.shard for r in got).values()} == {130}
    assert all(abs(part[k, s] - n / 8) < 2 for s, n in total.items() for k in range(8))
    rare = [sum(n for (k, s), n in part.items() if k == shard and s.startswith("rare")) for shard in range(8)]
    assert max(rare) <= 15


def test_shards_of_nothing(none):
    assert shards.shard_documents(none).count() == 0


def test_licenses(docs_of):
    altered = MIT.replace("<year> <copyright holders>", "2011 Some One").upper().replace(",", " ,")
    rows = [
        (1, altered, "s"),
        (2, ISC.replace("SOFTWARE", "software").replace("\n", "\n\n"), "s"),
        (3, "Some text.\nreleased UNDER the mit licence!\nSPDX-License-Identifier: 0BSD", "s"),
        (4, MIT + "\nAnd a line more.", "s"),
        (None, None, None),
        (5, "", "s"),
        (5, "", "s"),
        (6, "Copyright (c) 2020 A", "s"),
    ]
    got = {(r.doc_id, r.license, r.notices, r.n_notices) for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    assert got == {
        (1, "MIT", "", 0),
        (2, "ISC", "", 0),
        (3, None, "0BSD,MIT", 2),
        (4, None, "", 0),
        (None, None, "", 0),
        (5, None, "", 0),
        (6, None, "", 0),
    }


def test_licenses_of_odd_rows(odd, none):
    rows = license_scan.scan_licenses(odd).collect()
    assert len(rows) == len(ODD) and not any(r.license for r in rows)
    assert license_scan.scan_licenses(none).count() == 0


def filled(text, width):
    return textwrap.fill(text, width, break_long_words=False, break_on_hyphens=False)


def rewrapped(text, width):
    """Each paragraph anew, but claims, which have a line of their own."""
    parts = re.split(r"\n\s*\n|\n(?=\s*Copyright \([cC]\) [<12])|(?<=Foundation, Inc[.],)\n|(?<=Foundation, Inc[.])\n|(?<=fsf.org/>)\n", text)
    parts = [" ".join(p.split()) for p in parts]
    return "\n\n".join(p if re.match(r"\s*Copyright \([cC]\) [<12]", p) else filled(p, width) for p in parts)


@pytest.mark.parametrize("change", [str, str.upper, str.lower])
def test_licenses_at_any_width(change):
    for licence, text in TEXTS:
        own = license_scan.digest(license_scan.canonical_lines(text))
        for width in range(20, 130, 1 if len(text) < 4_000 else 11):
            lines = license_scan.canonical_lines(change(rewrapped(text, width)))
            assert license_scan.digest(lines) == own, (licence, width)


@pytest.mark.parametrize(
    "line",
    [
        "Copyright 2020", "Copyright (c) 2020 A", "# Copyright: 1999-2003, Some One", "(C) 2011 B", "© Some One",
        "Copyright [yyyy] [name of copyright owner]", "Copyright (c) Jane Doe. All rights reserved.",
        "Copyright by the Authors", "Copyright Some One", "COPYRIGHT THE REGENTS OF THE UNIVERSITY",
        "(c) Copyright 2001 C", "(c) Jane Doe", "Copyright © <year> <copyright holders>",
    ],
)
def test_claims_are_left_out(line):
    assert license_scan.canonical_lines(f"a\n{line}\nb") == [b"a", b"b"]


@pytest.mark.parametrize(
    "line",
    [
        "copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE FOR ANY",
        "copyright holder nor the names of its", "copyright", "copyrighted works", "copyright, patent and trademark",
        "(c) You must retain, in the Source form", "(c) Copyright notices must be kept", "copyright owner that",
    ],
)
def test_lines_of_a_body_stay(line):
    assert len(license_scan.canonical_lines(f"a\n{line}\nb")) == 3


def test_whole_texts_and_sentences(docs_of):
    whole = {path.stem: path.read_text() for path in FILES.glob("*.txt")}
    assert {"Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "Unlicense"} <= set(whole)
    said = {
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This software is released under the Mozilla Public License 2.0.": "MPL-2.0",
        "Licensed under a text of our own.": "Own",
    }
    said |= {f"SPDX-License-Identifier: {x}": x for x in NAMED}
    pairs = [*((text, x) for x, text in whole.items()), *said.items()]
    # A width that lets "copyright" and "(c)" open lines.
    pairs += [(rewrapped(text.partition(END)[0] + END, 61), x) for x, text in whole.items() if END in text]
    more = [("Own", "licensed under A TEXT of our own")]
    got = license_scan.scan_licenses(docs_of([(i, text, "s") for i, (text, _) in enumerate(pairs)]), more=more)
    assert {r.doc_id: r.license for r in got.collect()} == {i: x for i, (_, x) in enumerate(pairs)}


def test_file_texts_at_any_width():
    for path in FILES.glob("*.txt"):
        # An example in the GPL's appendix has a claim within a sentence.
        text = path.read_text().partition(END)[0]
        own = license_scan.digest(license_scan.canonical_lines(text))
        for width in range(40, 121, 3):
            lines = license_scan.canonical_lines(rewrapped(text, width))
            assert license_scan.digest(lines) == own, (path.stem, width)


def test_no_text_stands_for_two_licences():
    found = defaultdict(set)
    for licence, text in known():
        found[license_scan.digest(license_scan.canonical_lines(text))].add(licence)
    assert all(len(x) == 1 for x in found.values())
