"""Licence notices by a positional index of rare licence words."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import lower_ascii
from seqloom.llm.secrets import bind

#: Anything between words: all ASCII but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Share of a template's words that must stand near their place, and how far from it they may.
LEAST_SHARE, SHIFT = 0.8, 4
#: Other spellings, and what they stand for outside the base phrases.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "favour": "favor"}


@dataclass(frozen=True)
class Template:
    """Words of a licence notice, its label, and the phrase (a part of the text) that has to be there word by word."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def _base(label: str, phrase: str) -> Template:
    return Template(label, phrase, phrase, base=True)


#: Fixed phrases and labels of the base, then notices in common use with their key phrases.
TEMPLATES = (
    _base("mit", "under the mit license"),
    _base("apache-2", "apache license version 2"),
    _base("cc-by-nc", "cc by nc"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl-3", "under the gnu lesser general public license version 3", "lesser general public license version 3"),
    Template("agpl-3", "under the gnu affero general public license version 3", "affero general public license version 3"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "free of charge to any person obtaining a copy",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "use this file except in compliance with the license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "use in source and binary forms",
    ),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "copy modify and or distribute"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


#: Whole notices, as their licences word them.
NOTICES = {
    "mit": (
        "free of charge to any person obtaining a copy of this software and associated documentation files",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "bsd": (
        "redistributions of source code must retain the above copyright notice",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    "isc": (
        "provided that the above copyright notice and this permission notice appear in all copies",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS.""",
    ),
    "zlib": (
        "the origin of this software must not be misrepresented",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "gpl-3": (
        "either version 3 of the license or at your option any later version",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    ),
}
TEMPLATES += tuple(
    Template(label, " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()), key)
    for label, (key, text) in NOTICES.items()
)


def words_of(text: Column) -> Column:
    """Lower-cased words in order: runs of ASCII digits and letters and of all other characters above ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP, -1), "")


def word_idf(templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of each licence word over the templates."""
    held = Counter(w for t in templates for w in set(t.words))
    return {w: math.log((len(templates) + 1) / (n + 0.5)) for w, n in held.items()}


def postings(templates: tuple[Template, ...]) -> dict[str, list[dict[str, int]]]:
    """The index: ``word -> [(template, place, turn)]`` of the two words of highest IDF in each key phrase.

    The rarer one has turn 0, the other turn 1, earlier places first on ties; the word of a phrase of one word has both. A
    notice has its key phrase whole, so it has both words, at their distance.
    """
    idf, out = word_idf(templates), {}
    for number, t in enumerate(templates):
        places = sorted(enumerate(t.key.split(), start=t.key_at), key=lambda x: (-idf[x[1]], x[0]))
        for turn, (place, word) in enumerate((places * 2)[:2]):
            out.setdefault(word, []).append({"t": number, "place": place, "turn": turn})
    return out


#: A vote is one number: the template above these bits, the start below, moved so that it is not negative.
_START_BITS, _MOVED = 40, 1 << 20


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``docs`` with ``n_words`` and ``notices``, an array of ``(start, label, base, share)`` with one row per place found.

    Of a file's words those of highest IDF among licence words, as far as it has them, are looked up in the index. Each
    posting, less its place in the template, votes for a start of that template; a template is looked at only where
    the votes of its two rarest words meet. There its mandatory key phrase has to stand word by word. ``share`` is the part
    of the template's words that stand within ``SHIFT`` of their place, so words may be altered, left out or put in;
    ``least_share`` is asked for, all words for a base phrase. Other spellings count as the same word, but not in base phrases.

    The index and the templates are data of one expression, so neither the plan nor the work on a file grows with the number
    of templates, but with the votes that its words cast. IDF is taken over the templates: a file has the same notices in any
    corpus. Words count from 0 over the whole text; a notice that lacks its first words starts at its first word at the
    earliest. A null or empty text has none. Rows are scanned one by one, so that repeated rows get equal results, and all
    columns pass through.
    """
    index = postings(templates)
    asked = sorted({*index, *(w for w, same in SPELLINGS.items() if same in index)})
    index_data = F.from_json(F.lit(json.dumps(index)), "map<string,array<struct<t:int,place:int,turn:int>>>")
    rows = [
        {"label": t.label, "base": t.base, "words": t.words, "key": t.key.split(), "key_at": t.key_at} for t in templates
    ]
    template_data = F.from_json(
        F.lit(json.dumps(rows)), "array<struct<label:string,base:boolean,words:array<string>,key:array<string>,key_at:int>>"
    )
    spellings = F.from_json(F.lit(json.dumps(SPELLINGS)), "map<string,string>")
    none = F.array().cast("array<struct<start:int,label:string,base:boolean,share:double>>")

    def plain(word: Column) -> Column:
        return F.coalesce(F.try_element_at(spellings, word), word)

    def votes(hits: Column, turn: int) -> Column:
        def of(hit: Column) -> Column:
            own = F.filter(F.try_element_at(index_data, plain(hit["word"])), lambda p: p["turn"] == turn)
            return F.transform(own, lambda p: p["t"].cast("long") * (1 << _START_BITS) + (hit["at"] - p["place"] + _MOVED))

        return F.flatten(F.transform(hits, of))

    def meeting(words: Column, hits: Column) -> Column:
        def checked(starts: Column) -> Column:
            same = F.transform(words, plain)
            return bind(same, lambda same: F.filter(F.transform(starts, _notice(template_data, words, same)), _holds(least_share)))

        both = F.array_intersect(votes(hits, 0), votes(hits, 1))
        return bind(both, lambda starts: F.when(F.size(starts) > 0, checked(starts)).otherwise(F.array()))

    def notices(words: Column) -> Column:
        placed = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word")))
        hits = F.filter(placed, lambda h: h["word"].isin(*asked))
        found = bind(hits, lambda hits: F.when(F.size(hits) > 0, meeting(words, hits)).otherwise(F.array()))
        names = ("start", "label", "base", "share")
        return F.concat(none, F.transform(found, lambda x: F.struct(*(x[n].alias(n) for n in names))))

    marked = docs.withColumn("words", words_of(F.col("text")))
    found = bind(F.col("words"), notices)
    return marked.withColumns({"n_words": F.size("words").cast("long"), "notices": found}).drop("words")


def _notice(templates: Column, words: Column, same: Column) -> Callable[[Column], Column]:
    """The template of a vote against the words: whether its key phrase stands there, and the share of its words."""

    def build(vote: Column) -> Column:
        start = (vote % (1 << _START_BITS) - _MOVED).cast("int")
        return bind(F.get(templates, F.floor(vote / (1 << _START_BITS)).cast("int")), lambda t: compare(t, start))

    def compare(t: Column, start: Column) -> Column:
        def stands(where: Column) -> Column:
            return F.slice(where, start + t["key_at"] + 1, F.size(t["key"])) == t["key"]

        def near(word: Column, place: Column) -> Column:
            first = F.greatest(start + place - SHIFT, F.lit(0))
            return F.array_contains(F.slice(same, first + 1, F.greatest(start + place + SHIFT + 1 - first, F.lit(0))), word)

        agree = F.size(F.filter(F.zip_with(t["words"], F.sequence(F.lit(0), F.size(t["words"]) - 1), near), lambda x: x))
        key = (start + t["key_at"] >= 0) & F.when(t["base"], stands(words)).otherwise(stands(same))
        share = F.when(~key, 0.0).when(t["base"], 1.0).otherwise(agree / F.size(t["words"]).cast("double"))
        return F.struct(
            F.greatest(start, F.lit(0)).alias("start"), t["label"].alias("label"), t["base"].alias("base"), share.alias("share")
        )

    return build


def _holds(least: float) -> Callable[[Column], Column]:
    return lambda x: (x["share"] >= least - 1e-9) & (x["share"] > 0)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document of ``scan``: numbers of words and base phrases, their first and last start, labels and score.

    The score is the best share of any notice, 0 without one.
    """
    base = F.filter("notices", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"].cast("long"))

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda x: x["label"]))), ",")

    return docs.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("notices")).alias("labels"),
        F.coalesce(F.array_max(F.transform("notices", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
