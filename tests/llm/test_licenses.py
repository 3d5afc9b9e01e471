"""Each rule on its notice as it is usually printed: wrapped, indented and commented."""

import textwrap

import pytest

from cantor.llm import licenses

GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.",
)
APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "    http://www.apache.org/licenses/LICENSE-2.0")
MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
)
BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.")
BSD3 = (*BSD2, "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",)
NOTICES = {"GPL-3.0-or-later": GPL, "Apache-2.0": APACHE, "MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "ISC": ISC}
#: The rules of one sentence, each as it is looked up.
NOTICES |= {name: (licenses.SENTENCES[ids[0]].capitalize() + ".",) for name, ids in licenses.RULES if len(ids) == 1 and name not in NOTICES}


@pytest.mark.parametrize("mark", ["", "    ", " * ", "# ", "// "])
def test_every_notice_is_recognised(spark, mark):
    rows = []
    for name in NOTICES:
        for width in (40, 60, 72, 79, 10_000):
            lines = [line for part in NOTICES[name] for line in [*textwrap.wrap(part, width), ""]]
            rows.append((f"{name}:{width}", "Some title\n\n" + "\n".join(mark + x for x in lines) + "\nint main\n"))
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {k: k.split(":")[0] for k, _ in rows}


def test_part_of_a_sentence_is_no_licence(spark):
    texts = ["He said it was released under the MIT license", "Licensed under the MIT license of old", GPL[0]]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.license for r in sorted(got, key=lambda r: r.doc_id)] == [None, None, None]
