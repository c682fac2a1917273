import re

from pyspark.sql import functions as F

from recordforge.llm import licenses as li

TEXTS = [
    None, "", "plain text\nwithout any", "prose here.\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.\nmore\nAll rights reserved.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "He lost his driving license in Paris.",
    "Distributed under the Zorg software licence, see zorg.", "license " * 20_000, "MIT", "É licensed ü\r\nSPDX-License-Identifier: MIT", "Er kam MIT DEM Zug und mit der Bahn.",
    "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n */\nint main;",
    "Notes.\n\nPermission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files.",
]


def brute(doc_id, text):
    m, out = li.model(), []
    for i, line in enumerate(li.unwrapped(text or "")):
        if not re.search(li.ANCHOR, line, re.ASCII):
            continue
        p = m.predict(line)
        best = max(p, key=p.get)
        if best == "none" or p["none"] > 1 - li.SURE:
            continue
        share = li.template_share(line, best) if best in li.TEMPLATES else 0.0
        sure = best in li.TEMPLATES and p[best] >= li.SURE and share >= li.CONFIRM
        out.append((doc_id, i, best if sure else "unknown", round(float(p[best]), 6), round(share, 6), line))
    return out


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[3]), (3, TEXTS[3])] + [(100 + i, t) for i, (_, t) in enumerate(li.training_lines(seed=77, n=300))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    df.repartition(3).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = li.op4_licenses(spark, f"{tmp_path}/a").collect()
    want = [x for d, t in rows for x in brute(d, t)]
    assert sorted(str((r.doc_id, r.paragraph, r.license, round(r.probability, 6), round(r.template_share, 6), r.notice)) for r in got) == sorted(map(str, want))
    found = {(r.doc_id, r.license) for r in got}
    assert {(3, "mit"), (4, "cc-by-nc"), (4, "proprietary"), (5, "gpl"), (6, "apache"), (8, "unknown"), (11, "mit"), (13, "gpl"), (14, "mit")} <= found
    assert not any(d in (7, 10, 12) for d, _ in found)
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert li.op4_licenses(spark, f"{tmp_path}/b").collect() == []


def test_held_out_accuracy():
    lines, m = li.training_lines(seed=123, n=600), li.model()
    right = sum(max(p, key=p.get) == k for k, t in lines for p in [m.predict(t)])
    assert right >= 0.96 * len(lines)


#: By hand: notices as they stand in the wild, and lines that are none.
HAND = [
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions"),
    ("gpl", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("bsd", "Copyright (c) 1983, 1993 The Regents of the University of California.  All rights reserved."),
    ("mit", "Dies ist unter der MIT-Lizenz veröffentlicht."),
    ("gpl", "Ce programme est distribué sous licence GPL"),
    ("mit", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("lgpl", "License as published: GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("proprietary", "(c) 2015 Acme Corp. All rights reserved."),
    ("unknown", "This software is licensed under the Foobar Public License 1.1"),
    ("none", "We hold a license to sell beer."),
    ("none", "The quick brown fox lives here with permission."),
    ("none", "She teaches physics at MIT in Boston."),
    ("none", "The warranty on my phone ended last week."),
    ("none", "Er fuhr mit dem Zug nach Bonn."),
    ("none", "An Apache chief met the settlers in 1871."),
]


def test_lines_by_hand(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(HAND)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in li.scan(df).collect()}
    wrong = [(k, got.get(i, "none"), t) for i, (k, t) in enumerate(HAND) if got.get(i, "none") != k]
    assert len(wrong) <= 1, wrong


def test_hints_stand_wherever_an_anchor_does(spark):
    words = ["MIT", "licence", "License", "Lizenz", "licenza", "copyright", "copyleft", "GPLv2", "LGPL", "agpl", "GNU", "apache", "Creative Commons", "cc by", "CC-BY", "ccby", "cc0", "CC 0", "cc-0", "public domain", "rights reserved", "permission",
             "redistributed", "proprietary", "MPL", "SPDX", "warranty", "warranties", "liable", "noninfringement", "merchantability", "unauthorized copying", "contributors may"]
    for w in words:
        assert re.search(li.ANCHOR, f"a {w} b", re.ASCII), w
        assert "MIT" in w or any(h in w.lower() for h in li.HINTS), w
