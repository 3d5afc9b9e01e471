"""Licence recognition by sentence rules.

Texts are cut into sentences, each is normalised and looked up in a table of known licence sentences. A known sentence
may also run over several cuts, as wrapped, indented and commented notices are cut at line ends, and some at ':' and ';'
within. What is left is a short sequence of sentence identifiers, which ordered licence rules are matched against. A rule is a list of
identifiers that must come in this order, other known sentences between them allowed. Rules are tried in their
order; all that match are reported, the first is the document's licence.

All of it is expressions inside one row: nothing is shuffled, and both tables are literals of fixed size.

Defined results: null and empty texts have no sentence and no licence. Repeated rows get repeated results. An empty
table gives an empty result. Only key and text are read, so clashing names can't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentences of common licence notices, by identifier.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-notice": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "mit-short": "released under the mit license",
    "mit-short-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl2-short": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "by-short": "licensed under cc by 4 0",
    "by-sa-short": "licensed under cc by sa 4 0",
    "by-nc-short": "licensed under cc by nc 4 0",
    "cc0-short": "licensed under cc0 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib-permit": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost": "distributed under the boost software license version 1 0",
    "epl": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
    "by-nd-short": "licensed under cc by nd 4 0",
    "by-nc-sa-short": "licensed under cc by nc sa 4 0",
    "rights": "all rights reserved",
}
#: Ordered rules: licence, identifiers in order.
RULES = (
    ("Apache-2.0", ("apache-notice", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-short",)),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-short-2",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    ("AGPL-3.0-or-later", ("agpl-free",)),
    ("LGPL-2.1-or-later", ("lgpl-free",)),
    ("MPL-2.0", ("mpl-terms",)),
    ("EPL-2.0", ("epl",)),
    ("BSL-1.0", ("boost",)),
    ("Zlib", ("zlib-permit",)),
    ("Unlicense", ("unlicense",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-2.0-only", ("gpl2-short",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source")),
    ("ISC", ("isc-grant",)),
    ("CC-BY-NC-4.0", ("by-nc-short",)),
    ("CC-BY-NC-SA-4.0", ("by-nc-sa-short",)),
    ("CC-BY-ND-4.0", ("by-nd-short",)),
    ("CC-BY-SA-4.0", ("by-sa-short",)),
    ("CC-BY-4.0", ("by-short",)),
    ("CC0-1.0", ("cc0-short",)),
    ("proprietary", ("rights",)),
)
#: A line that starts with a small letter continues the line before.
WRAP = "\n([a-z])"
#: A sentence ends at a line's end, or at . ! ? : ; before white space or a double quote.
END = '[.!?:;]+["\\x20\\x09\\x0B-\\x0D]|[.!?:;]*\\n'
JUNK = "[^a-z0-9]+"
#: Each bundled sentence has one of these.
HINT = "(?i)licen|permi|copyright|redistrib|warrant|rights|compliance|unencumbered"


def known_pattern(sentences: dict[str, str]) -> str:
    """Known sentences from cut to cut, any cuts between their words; longer ones are tried first."""
    return "(?<=\\|)(?:" + "|".join(v.replace(" ", "[ |]") for v in sorted(sentences.values(), key=len, reverse=True)) + ")(?=\\|)"


def normalised(sentence: Column) -> Column:
    """Lower case, everything but ASCII letters and digits as one space."""
    return F.btrim(F.regexp_replace(F.lower(sentence), JUNK, " "), F.lit(" "))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES, rules: Sequence[tuple[str, tuple[str, ...]]] = RULES, hint: str | None = HINT) -> DataFrame:
    """doc_id, n_sentences, sentence_ids (in order, comma-joined), license_ids (by rule order), license.

    sentences: normalised known sentences by identifier; rules: licences and identifiers in order, the most telling rule first; hint: a
    pattern that some sentence of any text with a known sentence matches, None to try all texts. They are literals of the plan, meant for
    tables of up to some thousands of entries.
    """
    known = F.create_map(*[x for k, v in sentences.items() for x in (F.lit(v), F.lit(k))])
    cut = docs.select(F.col(key).alias("doc_id"), F.filter(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WRAP, " $1"), END), lambda s: F.btrim(s, F.lit(" \t")) != "").alias("_s"))
    # Only texts with a hint are normalised: as |sentence|sentence|, without those that have no letter or digit.
    pieces = F.filter(F.transform("_s", normalised), lambda s: s != "")
    told = F.exists("_s", lambda s: s.rlike(hint)) if hint else F.lit(True)
    marked = F.when(told, F.concat(F.lit("|"), F.array_join(pieces, "|"), F.lit("|"))).otherwise("")
    hit = F.transform(F.regexp_extract_all(marked, F.lit(known_pattern(sentences)), 0), lambda m: F.try_element_at(known, F.translate(m, "|", " ")))
    rows = cut.withColumn("_k", hit)
    line = F.concat(F.lit(","), F.array_join("_k", ",,"), F.lit(","))
    found = rows.select("doc_id", F.size("_s").cast("long").alias("n_sentences"), F.array_join("_k", ",").alias("sentence_ids"), line.alias("_line"))
    hits = [F.when(F.col("_line").like("%," + ",%,".join(ids) + ",%"), F.lit(name)) for name, ids in rules]
    names = F.array_distinct(F.array_compact(F.array(*hits)))
    return found.withColumn("_n", F.when(F.col("_line") == ",,", F.array().cast("array<string>")).otherwise(names)).select("doc_id", "n_sentences", "sentence_ids", F.array_join("_n", ",").alias("license_ids"), F.get("_n", F.lit(0)).alias("license"))
