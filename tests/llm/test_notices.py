import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.notices import PHRASES, NoticeSearch, normal, scan_documents
from tessera.llm.queries import op10_fuzzy_notices

SF = "/root/testdata/sf0.001"
SEARCH = NoticeSearch()


def least_edits(needle: str, text: str) -> int:
    """Brute force: edits of the needle against its best substring."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(needle, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def brute(text: str):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, lab) for p, lab in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    t = normal(text.encode())
    labels = {lab for _, lab in base} | {lab for n, lab, k, _ in SEARCH.notices if least_edits(n, t) <= k}
    return len(words), base, labels


def check(r, text):
    n, base, labels = brute(text)
    assert (r[0], r[1]) == (n, len(base))
    assert r[2] == min([w for w, _ in base], default=None) and r[3] == max([w for w, _ in base], default=None)
    assert r[4] == ",".join(sorted({x for _, x in base}))
    assert r[5] == ",".join(sorted(labels))
    assert 0 <= r[6] <= 1 and (r[6] > 0) == bool(labels)


NOTE = "Licensed under the Apache License, Version 2.0. All rights reserved! general public license cc by Released under the MIT License"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, len(NOTE)), st.sampled_from(["", "x", " ", "é", "-"]), st.booleans()), max_size=9))
def test_edited_notices_equal_brute_force(edits):
    t = NOTE
    for at, put, cut in edits:
        t = t[:at] + put + t[at + cut:]
    check(SEARCH.scan(t.encode()), t)


def test_long_notices_are_whole():
    rest = " source and binary forms, with or without modification, are permitted"
    t = "Rexdistrixbution andx usxe xinx" + rest  # 6 edits, all in the first clause
    check(SEARCH.scan(t.encode()), t)
    assert SEARCH.scan(t.encode())[5] == "bsd"
    for t in ("Redistribution and use in source and binary forms are discussed", "Permission is hereby granted, free of charge, by nobody at all",
              "Permission to use, copy, modify, and distribute this software is refused"):
        check(SEARCH.scan(t.encode()), t)
        assert SEARCH.scan(t.encode())[5] == ""


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in op10_fuzzy_notices(spark, SF).collect()}
    docs = [d for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert len(rows) == len(docs)
    for d in docs:
        if len(d.text) < 1500:
            r = rows[d.doc_id]
            check((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score), d.text)
    assert any(r.labels for r in rows.values())


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, "All RIGHTS reserved " * 3, None)], "doc_id long, text string, LABELS string")
    r = scan_documents(df).collect()
    assert [x.n_words for x in r] == [0, 0, 9] and [x.score for x in r] == [0.0, 0.0, 1.0]
    assert (r[2].n_base, r[2].first_word, r[2].last_word, r[2].labels) == (3, 0, 6, "reserved") and r[0].first_word is None
    assert scan_documents(df.limit(0)).count() == 0
