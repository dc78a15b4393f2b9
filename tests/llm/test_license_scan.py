import random
import re

from lexiloom.llm import license_scan as scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in scan.PHRASES:
        phrase = phrase.split()
        for at in range(len(words) - len(phrase) + 1):
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places(spark, odd_docs, small_docs):
    rng = random.Random(1)
    words = "cc by BY-nc all rights reserved General public license, x é 7".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").union(odd_docs.select("doc_id", "text"))
    df = df.union(small_docs.selectExpr("doc_id + 1000", "text"))
    texts = sorted(((r.doc_id, *plain(r.text)) for r in df.collect()), key=repr)
    rows = scan.scan(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr) == texts
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)


def test_templates_with_edits(spark):
    pad = "these are other words of no license at all " * 5
    texts = {
        1: f"{pad} Released under the MIT License. {pad}",
        2: f"{pad} Licensed under the Apache License, Version 2.0 (the License) {pad}",
        3: f"{pad} permission is hereby granted, entirely free of charge, to any person obtaining one copy of this software {pad}",
        4: f"{pad} the license of a driver; the apache are a people; mit dem license plate {pad}",
        5: f"{pad} redistribution and use in source and binary forms are a crime {pad}",
        6: "Licensed under CC BY-NC 4.0. " * 3,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in scan.scan(df).collect()}
    assert found == {1: "mit", 2: "apache-2.0", 3: "mit", 4: "", 5: "", 6: "cc-by,cc-by-nc"}


def test_odd_rows(spark, odd_docs):
    assert scan.scan(odd_docs).count() == odd_docs.count()
    assert scan.scan(odd_docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License")] * 3 + [(None, "Released under the MIT License")], "doc_id long, text string")
    assert [r.labels for r in scan.scan(twice).collect()] == ["mit"] * 4


def test_whole_texts_with_edits_and_breaks(spark):
    """Bodies of hundreds of words with words changed, left out and put in, and cut openings: recall over all templates."""
    rng = random.Random(9)
    pad = " ".join(f"filler{i}" for i in range(40))
    rows, want = [], {}
    for number, (label, text) in enumerate(t for t in scan.TEMPLATES if len(t[1].split()) > 60):
        for copy in range(4):
            words = text.split()
            for _ in range(len(words) // 20):
                at = rng.randrange(len(words))
                kind = rng.random()
                words[at : at + 1] = [f"x{at}"] if kind < 0.4 else [] if kind < 0.7 else [words[at], "really"]
            body = ", ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
            rows.append((10 * number + copy, f"{pad} {body.upper() if copy == 3 else body}. {pad}"))
            want[10 * number + copy] = label
    rows += [(1000 + i, " ".join(rng.sample(scan.TEMPLATES[2][1].split() * 3, 150))) for i in range(10)]
    found = {r.doc_id: (r.labels.split(","), r.score) for r in scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(want[i] in found[i][0] and found[i][1] > 0.75 for i in want)
    assert all(found[i][0] == [""] for i in found if i >= 1000)


def test_many_matches_take_time_in_proportion(spark):
    """One text with thousands of license lines: no text travels with a match."""
    line = "Released under the MIT License. Some other words stand here. "
    df = spark.createDataFrame([(1, line * 4_000), (2, line * 2), (3, None)], "doc_id long, text string")
    plan = scan.template_labels(df)._jdf.queryExecution().executedPlan().toString()
    assert "first(text" not in plan
    assert {r.doc_id: r.labels for r in scan.scan(df).collect()} == {1: "mit", 2: "mit", 3: ""}
