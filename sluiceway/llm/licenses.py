"""License notices by ordered signature rules, with DataFrame functions only.

A rule has a label, keywords, a regular expression and a priority. Texts without any rule's keyword
are passed over; in the others only rules whose keywords occur are tried. Of overlapping
detections one inside another rule's interval goes if that rule comes before it.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words: letters and digits of ASCII, and all beyond it. Fixed by the contract of the base phrases.
_IN = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORD = rf"[{_IN}]+"
_GAP = rf"[^{_IN}]+"
_FRONT, _BACK = rf"(?<![{_IN}])", rf"(?![{_IN}])"
BASE_PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}

# Names of licenses as they are written: label, identifier, words that the name needs, pattern of the name.
_V = r"(?:,?\s+version\s+|\s+v?\.?\s*|-)"
NAMES = [
    ("apache-2.0", "apache-2\\.0", "apache", rf"apache(?:\s+software)?\s+licen[cs]e{_V}2(?:\.0)?"),
    ("apache-1.1", "apache-1\\.1", "apache", rf"apache(?:\s+software)?\s+licen[cs]e{_V}1\.1"),
    ("apache", "apache", "apache", r"apache(?:\s+software)?\s+licen[cs]e"),
    ("mit", "mit", "mit", r"mit(?:\s+style)?\s+licen[cs]e"),
    ("x11", "x11", "x11", r"x11\s+licen[cs]e"),
    ("isc", "isc", "isc", r"isc\s+licen[cs]e"),
    ("0bsd", "0bsd", "bsd", r"(?:zero[- ]clause|0[- ]clause)\s+bsd(?:\s+licen[cs]e)?"),
    ("bsd-2-clause", "bsd-2-clause", "bsd", r"(?:bsd[- ]2[- ]clause|(?:two|2)[- ]clause\s+bsd|simplified\s+bsd)(?:\s+licen[cs]e)?"),
    ("bsd-3-clause", "bsd-3-clause", "bsd", r"(?:bsd[- ]3[- ]clause|(?:three|3)[- ]clause\s+bsd|(?:new|modified|revised)\s+bsd)(?:\s+licen[cs]e)?"),
    ("bsd-4-clause", "bsd-4-clause", "bsd", r"(?:bsd[- ]4[- ]clause|(?:four|4)[- ]clause\s+bsd|original\s+bsd)(?:\s+licen[cs]e)?"),
    ("bsd", "bsd", "bsd", r"bsd(?:\s+style)?\s+licen[cs]e"),
    ("agpl-3.0", "agpl-3\\.0(?:-only|-or-later)?", "affero", rf"(?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e{_V}3(?:\.0)?"),
    ("agpl", "agpl", "affero", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e"),
    ("lgpl-3.0", "lgpl-3\\.0(?:-only|-or-later)?", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[cs]e{_V}3(?:\.0)?"),
    ("lgpl-2.1", "lgpl-2\\.1(?:-only|-or-later)?", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[cs]e{_V}2\.1"),
    ("lgpl-2.0", "lgpl-2\\.0(?:-only|-or-later)?", "library", rf"(?:gnu\s+)?library\s+general\s+public\s+licen[cs]e{_V}2(?:\.0)?"),
    ("lgpl", "lgpl", "general public", r"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[cs]e"),
    ("gpl-3.0", "gpl-3\\.0(?:-only|-or-later)?", "general public", rf"(?:gnu\s+)?general\s+public\s+licen[cs]e{_V}3(?:\.0)?"),
    ("gpl-2.0", "gpl-2\\.0(?:-only|-or-later)?", "general public", rf"(?:gnu\s+)?general\s+public\s+licen[cs]e{_V}2(?:\.0)?"),
    ("gpl", "gpl", "general public", r"(?:gnu\s+)?general\s+public\s+licen[cs]e"),
    ("gpl-abbreviated", "gnu-gpl", "gpl", r"(?:gnu\s+)?gpl\s*v?[23](?:\.0)?(?:\s+licen[cs]e)?"),
    ("gfdl", "gfdl-1\\.[123]", "documentation", r"(?:gnu\s+)?free\s+documentation\s+licen[cs]e"),
    ("mpl-2.0", "mpl-2\\.0", "mozilla", rf"mozilla\s+public\s+licen[cs]e{_V}2(?:\.0)?"),
    ("mpl-1.1", "mpl-1\\.1", "mozilla", rf"mozilla\s+public\s+licen[cs]e{_V}1\.1"),
    ("mpl", "mpl", "mozilla", r"mozilla\s+public\s+licen[cs]e"),
    ("epl-2.0", "epl-2\\.0", "eclipse", rf"eclipse\s+public\s+licen[cs]e{_V}2(?:\.0)?"),
    ("epl-1.0", "epl-1\\.0", "eclipse", rf"eclipse\s+public\s+licen[cs]e{_V}1(?:\.0)?"),
    ("epl", "epl", "eclipse", r"eclipse\s+public\s+licen[cs]e"),
    ("cddl-1.0", "cddl-1\\.[01]", "common development", r"common\s+development\s+and\s+distribution\s+licen[cs]e"),
    ("cpl-1.0", "cpl-1\\.0", "common public", r"common\s+public\s+licen[cs]e"),
    ("eupl-1.2", "eupl-1\\.[12]", "european union", r"european\s+union\s+public\s+licen[cs]e"),
    ("artistic-2.0", "artistic-2\\.0", "artistic", rf"artistic\s+licen[cs]e{_V}2(?:\.0)?"),
    ("artistic", "artistic-1\\.0", "artistic", r"artistic\s+licen[cs]e"),
    ("bsl-1.0", "bsl-1\\.0", "boost", r"boost\s+software\s+licen[cs]e"),
    ("busl-1.1", "busl-1\\.1", "business source", r"business\s+source\s+licen[cs]e"),
    ("sspl-1.0", "sspl-1\\.0", "server side", r"server\s+side\s+public\s+licen[cs]e"),
    ("elastic-2.0", "elastic-2\\.0", "elastic", r"elastic\s+licen[cs]e"),
    ("zlib", "zlib", "zlib", r"zlib(?:/libpng)?\s+licen[cs]e"),
    ("psf-2.0", "psf-2\\.0|python-2\\.0", "python", r"python\s+software\s+foundation\s+licen[cs]e"),
    ("ruby", "ruby", "ruby", r"ruby(?:'s)?\s+licen[cs]e"),
    ("php-3.01", "php-3\\.0?1?", "php", r"php\s+licen[cs]e"),
    ("postgresql", "postgresql", "postgresql", r"postgresql\s+licen[cs]e"),
    ("openssl", "openssl", "openssl", r"openssl\s+licen[cs]e"),
    ("ofl-1.1", "ofl-1\\.1", "open font", r"(?:sil\s+)?open\s+font\s+licen[cs]e"),
    ("odbl-1.0", "odbl-1\\.0", "open database", r"open\s+database\s+licen[cs]e"),
    ("wtfpl", "wtfpl", "wtfpl", r"wtfpl"),
    ("unlicense", "unlicense", "unlicense", r"(?:the\s+)?unlicense"),
    ("cc0-1.0", "cc0-1\\.0", "cc0", r"cc0(?:\s+1\.0)?(?:\s+universal)?"),
    ("cc-by-nc-nd", "cc-by-nc-nd-[1-4]\\.\\d", "nc-nd", r"cc[- ]by-nc-nd(?:\s+[1-4]\.\d)?"),
    ("cc-by-nc-sa", "cc-by-nc-sa-[1-4]\\.\\d", "nc-sa", r"cc[- ]by-nc-sa(?:\s+[1-4]\.\d)?"),
    ("cc-by-nc", "cc-by-nc-[1-4]\\.\\d", "by-nc", r"cc[- ]by-nc(?:\s+[1-4]\.\d)?"),
    ("cc-by-nd", "cc-by-nd-[1-4]\\.\\d", "by-nd", r"cc[- ]by-nd(?:\s+[1-4]\.\d)?"),
    ("cc-by-sa", "cc-by-sa-[1-4]\\.\\d", "by-sa", r"cc[- ]by-sa(?:\s+[1-4]\.\d)?"),
    ("cc-by", "cc-by-[1-4]\\.\\d", "cc", r"cc[- ]by(?:\s+[1-4]\.\d)?"),
    ("cc-by-nc", "cc-by-nc", "creative commons commercial", r"creative\s+commons\s+attribution[- ]non-?commercial(?:\s+[1-4]\.\d)?(?:\s+international)?(?:\s+licen[cs]e)?"),
    ("cc-by-sa", "cc-by-sa", "creative commons alike", r"creative\s+commons\s+attribution[- ]share-?alike(?:\s+[1-4]\.\d)?(?:\s+international)?(?:\s+licen[cs]e)?"),
    ("cc-by", "cc-by", "creative commons", r"creative\s+commons\s+attribution(?:\s+[1-4]\.\d)?(?:\s+international)?(?:\s+licen[cs]e)?"),
]
# How a name is used: rank, word of its own if any, pattern around the identifier or the name, score.
USES = [
    (0, "spdx", r"spdx-licen[cs]e-identifier:[\s(]*(?:{id})(?![\w.-])", 1.0),
    # Further identifiers of an expression, nearest first, so that none lies inside an interval that comes before it.
    *((0, "spdx", r"spdx-licen[cs]e-identifier:[\s(]*(?:[\w.+-]+[\s()]+(?:and|or|with)[\s(]+)" + times + r"(?:{id})(?![\w.-])", 1.0)
      for times in ("{{1}}", "{{2}}", "{{3,8}}")),
    (1, "licen", r"(?:dual[- ])?licen[cs]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{name})\b", 0.95),
    (1, "licen", r"\blicen[cs]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{id})(?!\w|\.\d)", 0.95),
    (2, "under", r"(?:released|distributed|published|available|provided|redistribut\w+)(?:\s+\w+){{0,3}}?\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{name})\b", 0.9),
    (3, "", r"\b(?:{name})\b", 0.7),
]
_S = r"(?:\s*v\.?\s*|,?\s+version\s+|[\s-]+)"
_G = r"(?:\s*v(?:\.\s*|\s+)|,?\s+version\s+|-)"     # what `gpl-abbreviated` doesn't take
_E = r"(?:-only|-or-later|\+)?(?!\w|\.\d)"
# Short names in prose: label, words, pattern, score.
SHORT = [
    ("agpl-3.0", "agpl", rf"\b(?:gnu\s+)?agpl{_S}3(?:\.0)?{_E}", 0.7),
    ("lgpl-3.0", "lgpl", rf"\b(?:gnu\s+)?lgpl{_S}3(?:\.0)?{_E}", 0.7),
    ("lgpl-2.1", "lgpl", rf"\b(?:gnu\s+)?lgpl{_S}2\.1{_E}", 0.7),
    ("lgpl-2.0", "lgpl", rf"\b(?:gnu\s+)?lgpl{_S}2(?:\.0)?{_E}", 0.7),
    ("gpl-3.0", "gpl", rf"\b(?:gnu\s+)?gpl{_G}3(?:\.0)?{_E}", 0.7),
    ("gpl-2.0", "gpl", rf"\b(?:gnu\s+)?gpl{_G}2(?:\.0)?{_E}", 0.7),
    ("agpl", "agpl", r"\b(?:gnu\s+)?agpl\b", 0.6),
    ("lgpl", "lgpl", r"\b(?:gnu\s+)?lgpl\b", 0.6),
    ("gpl", "gnu gpl", r"\bgnu\s+gpl\b", 0.6),
    ("apache-2.0", "apache-2", rf"\bapache-2(?:\.0)?{_E}", 0.7),
    ("mpl-2.0", "mpl", rf"\bmpl{_S}2(?:\.0)?{_E}", 0.7),
    ("epl-2.0", "epl", rf"\bepl-2(?:\.0)?{_E}", 0.7),
]
# Sentences of the notices themselves, fixed values: label, words, sentence, score.
SENTENCES = [
    ("bsl-1.0", "permission hereby granted", "permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", 0.95),
    ("ofl-1.1", "permission hereby granted", "permission is hereby granted, free of charge, to any person obtaining a copy of the font software", 0.95),
    ("mit", "permission hereby granted", "permission is hereby granted, free of charge", 0.9),
    ("bsd", "redistribution binary", "redistribution and use in source and binary forms", 0.9),
    ("bsd-3-clause", "endorse promote", "may be used to endorse or promote products derived from this software without specific prior written permission", 0.8),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software", 0.9),
    ("isc", "permission purpose", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", 0.95),
    ("isc", "permission purpose", "permission to use, copy, modify, and distribute this software for any purpose with or without fee", 0.95),
    ("0bsd", "permission purpose", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. the software is provided", 0.95),
    ("hpnd", "permission documentation", "permission to use, copy, modify, distribute, and sell this software and its documentation", 0.95),
    ("hpnd", "permission documentation", "permission to use, copy, modify, and distribute this software and its documentation", 0.95),
    ("permissive", "permission modify", "permission to use, copy, modify", 0.7),
    ("apache-2.0", "licen apache.org", "http://www.apache.org/licenses/license-2.0", 0.9),
    ("apache-2.0", "licen apache.org", "https://www.apache.org/licenses/license-2.0", 0.9),
    ("gpl", "free software general public", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation", 0.95),
    ("lgpl", "free software general public", "you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation", 0.95),
    ("agpl", "free software general public", "you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation", 0.95),
    ("mpl-2.0", "licen mozilla", "this source code form is subject to the terms of the mozilla public license, v. 2.0", 0.95),
    ("epl-2.0", "licen eclipse", "are made available under the terms of the eclipse public license", 0.9),
    ("cddl-1.0", "licen common development", "the contents of this file are subject to the terms of the common development and distribution license", 0.95),
    ("ofl-1.1", "licen font software", "this font software is licensed under the sil open font license", 0.95),
    ("zlib", "warranty as-is", "this software is provided 'as-is', without any express or implied warranty", 0.9),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain", 0.95),
    ("cc0-1.0", "waived copyright", "has waived all copyright and related or neighboring rights", 0.9),
    ("cc-by", "licen creativecommons.org", "creativecommons.org/licenses/by/", 0.9),
    ("cc-by-sa", "licen creativecommons.org", "creativecommons.org/licenses/by-sa/", 0.9),
    ("cc-by-nc", "licen creativecommons.org", "creativecommons.org/licenses/by-nc/", 0.9),
    ("cc-by-nd", "licen creativecommons.org", "creativecommons.org/licenses/by-nd/", 0.9),
    ("cc-by-nc-sa", "licen creativecommons.org", "creativecommons.org/licenses/by-nc-sa/", 0.9),
    ("cc-by-nc-nd", "licen creativecommons.org", "creativecommons.org/licenses/by-nc-nd/", 0.9),
]
OTHERS = [
    ("all-rights-reserved", "rights reserved", r"\ball\s+rights\s+reserved\b", 0.6),
    ("public-domain", "public domain", r"\b(?:released\s+(?:in)?to|placed\s+in|dedicated\s+to)\s+the\s+public\s+domain\b", 0.8),
    ("proprietary", "proprietary", r"\bproprietary\s+(?:and\s+confidential|licen[cs]e)\b", 0.6),
    ("copyright", "copyright", r"\bcopyright\s+(?:\(c\)\s+|©\s+)?(?:19|20)\d\d\b", 0.5),
    ("warranty-disclaimer", "warranty", r"\bwithout\s+warranty\s+of\s+any\s+kind\b", 0.4),
]


def _sentence(words: str) -> str:
    """The pattern of a sentence that lines may break, and comment signs begin, between any two words."""
    return r"(?:\s+(?:[*#/;-]+\s+)?)".join(re.escape(w.rstrip(",")) + (",?" if w.endswith(",") else "") for w in words.split())


def rules() -> list[tuple[str, tuple[str, ...], str, int, float]]:
    """(label, keywords, pattern, priority, score) in order; a lower priority comes first."""
    out = []
    for rank, own, around, score in USES:
        for label, identifier, keyword, name in NAMES:
            if own == "licen" and "{id}" in around:
                out.append((label, (own,), around.format(id=identifier), len(out), score))
                continue
            needs = "licen" if "licen[cs]e" in re.sub(r"\(\?:[^()]*\)\?", "", name) else ""
            keys = (own,) if own == "spdx" else tuple(dict.fromkeys(k for k in (*keyword.split(), own, needs) if k))
            out.append((label, keys, around.format(id=identifier, name=name), len(out), score))
    for label, keyword, sentence, score in SENTENCES:
        out.append((label, tuple(keyword.split()), _sentence(sentence), len(out), score))
    for label, keyword, pattern, score in (*SHORT, *OTHERS):
        out.append((label, tuple(keyword.split()), pattern, len(out), score))
    return out


def gate() -> list[tuple[str, ...]]:
    """All words of one of these are in every text that a rule can match: the rules' keywords, where no fewer will do."""
    sets = sorted({("licen",) if "licen" in keys else keys for _, keys, _, _, _ in rules()})
    implied = lambda these, by: by != these and all(any(b in t for t in these) for b in by)
    return [these for these in sets if not any(implied(these, by) for by in sets)]


def _rule_groups() -> Column:
    """The rules by their first keyword, as an array of literals."""
    groups: dict[str, list] = {}
    for label, keys, pattern, priority, score in rules():
        groups.setdefault(keys[0], []).append(F.struct(
            F.lit(label).alias("label"), F.array(*[F.lit(k) for k in keys]).alias("keys"),
            F.lit(pattern).alias("pattern"), F.lit(priority).alias("priority"), F.lit(score).alias("score")))
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*v).alias("rules")) for k, v in groups.items()])


def _intervals(text: Column, rule: Column) -> Column:
    """Each match of a rule: the text between matches says where they lie."""
    hit = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    between = F.split(text, rule["pattern"], -1)
    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("found"))

    def step(state, k):
        start = state["at"] + F.length(F.get(between, k))
        stop = start + F.length(F.get(hit, k))
        return F.struct(stop.alias("at"), F.concat(state["found"], F.array(
            F.struct(start.alias("start"), stop.alias("stop")))).alias("found"))

    order = F.when(F.size(hit) > 0, F.sequence(F.lit(0), F.size(hit) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    found = F.aggregate(order, begin, step)["found"]
    return F.transform(found, lambda s: F.struct(
        rule["label"].alias("label"), rule["priority"].alias("priority"), rule["score"].alias("score"),
        s["start"].alias("start"), s["stop"].alias("stop")))


def detections(text: Column) -> Column:
    """The notices of a text in small letters: array of (label, priority, score, start, stop)."""
    groups = F.filter(_rule_groups(), lambda g: F.contains(text, g["keyword"]))
    tried = F.filter(F.flatten(F.transform(groups, lambda g: g["rules"])),
                     lambda r: F.forall(r["keys"], lambda k: F.contains(text, k)))
    found = F.flatten(F.transform(tried, lambda r: _intervals(text, r)))
    return found


def _outranked(found: Column) -> Column:
    """The detections that lie in no interval of a rule that comes before theirs."""
    return F.filter(found, lambda d: ~F.exists(
        found, lambda o: (o["priority"] < d["priority"]) & (o["start"] <= d["start"]) & (o["stop"] >= d["stop"])))


def _phrase(words: tuple[str, ...]) -> str:
    return _FRONT + _GAP.join(words) + _BACK


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, notices, score) of `docs(doc_id, text)`.

    `base_labels` are those of the base phrases whose words stand one behind the other, `notices`
    the rules' detections that no earlier rule's interval holds, with places in the text in small letters.
    The score is that of the surest notice; 0.5 for a base phrase alone; 0 without either. Null is an empty
    text; repeated rows are scanned each; other columns are ignored.
    """
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = plain.withColumn("small", F.lower("text"))
    named = F.contains(F.col("small"), F.lit("license"))
    count = lambda pattern: F.when(named, F.regexp_count("text", F.lit("(?i)" + pattern))).otherwise(0)
    rows = rows.select(
        "doc_id", "text", "small", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        *[count(_phrase(words)).alias(f"n_{label}") for label, words in BASE_PHRASES.items()])
    rows = rows.withColumn("n_base", sum(F.col(f"n_{label}") for label in BASE_PHRASES).cast("long"))
    any_phrase = "(?:" + "|".join(_phrase(words) for words in BASE_PHRASES.values()) + ")"
    place = lambda before: F.when(F.col("n_base") > 0, F.regexp_count(
        F.regexp_extract("text", f"(?is)^({before}){any_phrase}", 1), F.lit(WORD)).cast("long"))
    gated = F.lit(False)
    for words in gate():
        gated = gated | reduce(and_, [F.contains(F.col("small"), F.lit(word)) for word in words])
    none = F.expr("cast(array() as array<struct<label:string,priority:int,score:double,start:int,stop:int>>)")
    rows = rows.select(
        "doc_id", "n_words", "n_base", place(".*?").alias("first_word"), place(".*").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.col(f"n_{x}") > 0, F.lit(x)) for x in BASE_PHRASES])).alias("base_labels"),
        F.when(gated, detections(F.col("small"))).otherwise(none).alias("found"))
    rows = rows.withColumn("notices", _outranked(F.col("found"))).drop("found")
    best = F.coalesce(F.array_max(F.transform("notices", lambda d: d["score"])), F.lit(0.0))
    return rows.withColumn("score", F.greatest(best, F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(0.0)))


def license_table(docs: DataFrame) -> DataFrame:
    """`scan_licenses` with labels as sorted text, joined by commas."""
    found = scan_licenses(docs)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", F.transform("notices", lambda d: d["label"]))).alias("labels"), "score")
