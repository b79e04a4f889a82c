"""Notices by their own sentences, identifiers of expressions and short names."""

from sluiceway.llm import licenses

TEXTS = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software", {"mit"}),
    ("// Redistribution and use in source\n// and binary forms, with or without", {"bsd"}),
    ("Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee", {"isc"}),
    ("Permission to use, copy, modify and so on", {"permissive"}),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"mit", "apache-2.0"}),
    ("SPDX-License-Identifier: (MIT AND ISC) OR BSD-3-Clause OR MPL-2.0", {"mit", "isc", "bsd-3-clause", "mpl-2.0"}),
    ("Licensed under GPL-3.0", {"gpl-3.0"}),
    ("LGPL v2.1 or AGPLv3", {"lgpl-2.1", "agpl-3.0"}),
    ("you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation", {"gpl"}),
    ("licensed under MIT", {"mit"}),
    ("the permission of the committee to use a copy of redistribution rules", set()),
    ("simplify and exemplify 2 or 3 ways with ruby, php and python", set()),
]


def test_notices(spark):
    rows = [(i, text) for i, (text, _) in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in licenses.license_table(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    for i, (text, labels) in enumerate(TEXTS):
        assert {x for x in got[i]["labels"].split(",") if x} == labels, text
        assert (got[i]["score"] > 0) == bool(labels)
