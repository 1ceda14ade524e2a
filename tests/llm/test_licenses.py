import math
import re
from collections import Counter

from lectern.llm import licenses as lic

FILES = "file long, path string, text string"


def brute(files, templates=lic.TEMPLATES, threshold=lic.THRESHOLD):
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    df, n = Counter(), len(files)
    for _, _, text in files:
        df.update(set(words(text or "")))
    idf = lambda w: math.log(1 + (1 + n) / (1 + df[w]))
    vector = lambda ws: {w: c * idf(w) for w, c in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [(name, len(words(t)), vector(words(t))) for name, t in templates]
    out = {}
    for file, _, text in files:
        found, said = [], words(text or "")
        for name, size, t in known:
            if not set(said) & set(t):
                continue
            for at in range(max(len(said) - size, 0) + 1):
                run = said[at:at + size]
                if not any(w in t for w in run):
                    continue
                v = vector(run)
                cosine = round(sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t), 6)
                if cosine >= threshold:
                    found.append((-cosine, name))
        if found:
            out[file] = min(found)
    return out


def nearest(files, own):
    declared = {}
    for file, path, _ in files:
        if path is not None and file in own and re.search(lic.LICENCE_FILE, path):
            d = path.rpartition("/")[0]
            declared[d] = min(declared.get(d, own[file]), own[file])
    out = {}
    for file, path, _ in files:
        d = None if path is None else path.rpartition("/")[0]
        while d is not None and file not in own:
            if d in declared:
                out[file] = (declared[d][1], d)
                break
            d = None if not d else d.rpartition("/")[0]
    return out


def compare(spark, files):
    own = brute(files)
    above = nearest(files, own)
    for r in lic.scan(spark.createDataFrame(files, FILES), "file", "path", "text").collect():
        name, score = (own[r.file][1], -own[r.file][0]) if r.file in own else (None, None)
        assert r.own == name and (score is None or abs(r.score - score) < 2e-6)
        assert (r.inherited, r.from_directory) == above.get(r.file, (None, None))
        assert r.licence == (name or above.get(r.file, (None,))[0])


def test_query_equals_brute_force(spark, documents):
    compare(spark, [tuple(r) for r in lic.file_paths(documents).collect()])


def test_inheritance(spark):
    mit, apache = "Released under the MIT License.", "code\nLicensed under the Apache License, Version 2.0.\nmore"
    compare(spark, [
        (1, "LICENSE", mit), (2, "a/x.py", "code"), (3, "a/b/LICENSE.txt", apache), (4, "a/b/c/d/y.py", "code"), (5, "a/b/c/d/z.py", mit),
        (6, "a/bb/w.py", "# released under the mit license"), (7, "a/b/COPYING", "All rights reserved."), (8, None, "code"), (9, "top.py", None), (10, "a/b/v.py", ""),
        (11, "e/NOTICE", "nothing here"), (12, "e/f.py", "code")])


def own(spark, *texts):
    """Licence and score of each text among a hundred others of plain words."""
    plain = [f"some plain words about the work of number {k}, all of them under the roof" for k in range(100)]
    rows = spark.createDataFrame([(k, f"d/{k}.txt", t) for k, t in enumerate([*texts, *plain])], FILES)
    found = {r.file: (r.own, r.score) for r in lic.scan(rows, "file", "path", "text").collect()}
    return [found[k] for k in range(len(texts))]


def test_wrapped_prefixed_and_embedded_notices(spark):
    wrapped = "# Permission is hereby granted, free of charge,\n# to any person obtaining a copy of this\n# software and associated documentation files\n# (the Software)"
    starred = "/*\n * Licensed under the Apache License,\n * Version 2.0 (the License); you may not use this\n * file except in compliance\n * with the License.\n */"
    inside = "Copyright (c) 2021 Jane Doe. All rights reserved. The rest is about something else."
    split = "a b c released\nunder\nthe\nmit\nlicense d e f"
    long = "word " * 50_000 + "this work is licensed under the GNU General Public License, version 3. " + "more " * 50_000
    assert own(spark, wrapped, starred, inside, split, long) == [("MIT", 1.0), ("Apache-2.0", 1.0), ("Proprietary", 1.0), ("MIT", 1.0), ("GPL-3.0", 1.0)]


def test_changed_notices_score_by_the_words_they_keep(spark):
    near = "This work is licensed under a Creative Commons Attribution 3.0 International License."
    far = "This work is about a licence that nobody has heard of, and not a creative one."
    (name, score), none = own(spark, near, far)
    assert name == "CC-BY-4.0" and 0.7 < score < 1 and none == (None, None)


def test_a_text_of_anchors_only(spark):
    files = [(1, "a", "licensed " * 300), (2, "b", "license mit " * 200 + "released under the mit license"), (3, "c", "reserved"), (4, "d", "rights reserved"), (None, "e", "All rights reserved.")]
    rows = {r.path: (r.own, r.score) for r in lic.scan(spark.createDataFrame(files, FILES), "file", "path", "text").collect()}
    known = brute(files)
    assert rows["e"] == (None, None)
    for file, path, _ in files[:-1]:
        name, score = (known[file][1], -known[file][0]) if file in known else (None, None)
        assert rows[path][0] == name and (score is None or abs(rows[path][1] - score) < 2e-6)


def test_a_line_without_anchors_cannot_reach_the_threshold():
    for seed in range(50):
        v = {f"t{k}": 1 + (seed * 7 + k * k) % 11 for k in range(1 + seed % 9)}
        chosen = set(lic.anchors(v, 0.7))
        rest = math.sqrt(sum(w * w for t, w in v.items() if t not in chosen))
        assert rest < 0.7 * math.sqrt(sum(w * w for w in v.values())) and chosen


def test_edges(edge, clashing, empty):
    scan = lambda t: lic.scan(lic.file_paths(t), "doc_id", "path", "text")
    assert scan(edge).count() == edge.count() and scan(clashing).count() == edge.count() and scan(empty).count() == 0
    assert all(r.own is None for r in scan(edge).collect())
