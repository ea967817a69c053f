"""License scans by sentence rules: sentences become known identifiers, and their order tells the license."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public license notices and headers, with the identifier of each.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-2.0-grant",
    "licensed under the apache license version 2 0 the license": "apache-2.0-grant",
    "you may not use this file except in compliance with the license": "apache-2.0-compliance",
    "you may obtain a copy of the license at": "apache-2.0-copy",
    "released under the mit license": "mit-grant",
    "licensed under the mit license": "mit-grant",
    "this project is licensed under the mit license": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-permission",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorsement",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0-grant",
    "licensed under the gnu general public license version 3": "gpl-3.0-grant",
    "licensed under the gnu general public license version 2": "gpl-2.0-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3.0-or-later-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2.0-or-later-grant",
    "licensed under the gnu lesser general public license version 3": "lgpl-3.0-grant",
    "licensed under the gnu affero general public license version 3": "agpl-3.0-grant",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2.0-grant",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0-grant",
    "licensed under cc by 4 0": "cc-by-4.0-grant",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0-grant",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0-grant",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0-grant",
    "all rights reserved": "all-rights-reserved",
}

# Ordered rules: a license is found where its identifiers appear in this order, others between them allowed.
RULES = [
    ("BSD-3-Clause", ["bsd-permission", "bsd-source", "bsd-binary", "bsd-endorsement"]),
    ("BSD-2-Clause", ["bsd-permission", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-2.0-grant"]),
    ("Apache-2.0", ["apache-2.0-compliance", "apache-2.0-copy"]),
    ("MIT", ["mit-permission", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("GPL-3.0-or-later", ["gpl-3.0-or-later-grant"]),
    ("GPL-2.0-or-later", ["gpl-2.0-or-later-grant"]),
    ("GPL-3.0-only", ["gpl-3.0-grant"]),
    ("GPL-2.0-only", ["gpl-2.0-grant"]),
    ("LGPL-3.0-only", ["lgpl-3.0-grant"]),
    ("AGPL-3.0-only", ["agpl-3.0-grant"]),
    ("MPL-2.0", ["mpl-2.0-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-grant"]),
    ("CC-BY-4.0", ["cc-by-4.0-grant"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-grant"]),
    ("Proprietary", ["all-rights-reserved"]),
]
# More sentences, as the ends of sentences yield them from the full public texts: MIT's first one goes on to its
# colon, and a GPL header is split after "free software", with a semicolon (version 2) once more.
STANDARD_SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-permission",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3.0-or-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2.0-or-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-redistribution",
    "either version 3 of the license or at your option any later version": "gpl-3.0-or-later-version",
    "either version 2 of the license or at your option any later version": "gpl-2.0-or-later-version",
}
STANDARD_RULES = [
    ("GPL-3.0-or-later", ["gpl-redistribution", "gpl-3.0-or-later-version"]),
    ("GPL-2.0-or-later", ["gpl-redistribution", "gpl-2.0-or-later-version"]),
]
# A rule's finding hides one whose identifiers it holds too.
HIDES = {"BSD-3-Clause": "BSD-2-Clause"}
# Sentences of so many words are no passing mention: wrapped ones may follow a line without an end of its own.
LONG_WORDS = 15
# No groups repeat in these: long runs of marks or blank lines would fill the stack.
COMMENT_MARKS = r"(?md)^[ \t#*;!:%'\">/]*+(?:<!--++|--++)?+[ \t]*+(?:(?:dnl|rem|c)(?=[ \t\r\n]))?+"
LIST_MARKERS = r"(?md)^[ \t]*(?:[-+\x{2022}]|\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)])[ \t]+"


def normalised(text: Column) -> Column:
    """Lower-case ASCII letters and digits with single spaces between; S where a sentence ends, L at other line ends.

    A sentence ends at . ; : ! or ? before white space, at blank lines and at list markers.
    """
    text = F.regexp_replace(F.lower(text), COMMENT_MARKS, "")
    text = F.regexp_replace(text, LIST_MARKERS, " S ")
    text = F.regexp_replace(text, r"[.;:!?](?:[ \t\r\n]|$)", " S ")
    text = F.trim(F.regexp_replace(F.regexp_replace(text, "\n", " L "), "[^a-z0-9SL]+", " "))
    return F.regexp_replace(F.concat(F.lit("S "), text, F.lit(" S")), "[SL ]{4,}", " S ")


def _sentence_pattern(sentences: list[str]) -> str:
    """A sentence from end to end over any lines, or from line end to line end on one line; the longest first."""
    ordered = sorted(sentences, key=len, reverse=True)
    over_lines = {s: s.replace(" ", "(?: L)? ") for s in ordered}
    whole = "|".join(over_lines.values())
    long = "|".join(over_lines[s] for s in ordered if len(s.split()) >= LONG_WORDS)
    line = "|".join(ordered)
    return f"(?<=S )(?:{whole})(?= S)|(?<=L )(?:{long})(?= S)|(?<=[SL] )(?:{line})(?= [SL])"


def _rule_pattern(identifiers: list[str]) -> str:
    return "," + "([^,]*,)*?".join(f"{i.replace('.', '[.]')}," for i in identifiers)


def scan_licenses(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, `sentence_ids` (identifiers in order) and `licenses` (found names, sorted).

    A sentence ends at . ; : ! or ? before white space, at blank lines and at list markers, and goes on
    over single line ends, with or without comment marks; else a line counts as a sentence. Only whole
    sentences count, compared after normalising, so running text that mentions a license is none. Of
    those that overlap, the first and longest counts. Null and empty texts
    have no sentences. Each row is handled alone: one pass without a shuffle, and repeated rows give
    repeated results. All whole rows come back, also those without a license.
    """
    identifiers_of = SENTENCES | STANDARD_SENTENCES
    known = F.create_map(*(F.lit(x) for pair in identifiers_of.items() for x in pair))
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Normalising costs most; rows in which no first word of any sentence appears skip it.
    openers = sorted({s.split()[0] for s in identifiers_of})
    suspect = F.col("text").rlike(r"(?i)\b(" + "|".join(openers) + r")\b")
    pattern = _sentence_pattern(list(identifiers_of))
    sentences = F.regexp_extract_all(normalised(F.col("text")), F.lit(pattern), F.lit(0))
    found = F.transform(sentences, lambda s: known[F.regexp_replace(s, " L ", " ")])
    rows = rows.select(
        "doc_id", F.when(suspect, found).otherwise(F.array().cast("array<string>")).alias("sentence_ids")
    )
    order = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    rows = rows.withColumn("order", order)
    names: dict[str, Column] = {}
    for name, identifiers in RULES + STANDARD_RULES:
        hit = F.col("order").rlike(_rule_pattern(identifiers))
        names[name] = names[name] | hit if name in names else hit
    for name, hidden in HIDES.items():
        names[hidden] = names[hidden] & ~names[name]
    listed = F.array(*(F.when(hit, F.lit(name)) for name, hit in sorted(names.items())))
    return rows.select("doc_id", "sentence_ids", F.filter(listed, lambda x: x.isNotNull()).alias("licenses"))
