"""License scans by ordered signature rules.

Words are runs of letters, digits and non-ASCII characters of the text with A-Z lower-cased. Base phrases are looked up
word by word; every place counts. The signature rules are regular expressions built from ``LICENSES`` and ``TEMPLATES``
(several hundred), each with the keywords that gate it, one for each alternative of its name: a rule only runs on a text
that holds one of them. A text is only cut into words if it holds a word that all rules need or one of a base phrase. Rules
of higher priority come first, and spans inside a kept span are suppressed; spans that only overlap a kept one stay. Labels of base phrases
always stay.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are scanned alike; extra columns
are ignored; whole texts are scanned, and only the places around keywords cost more than one pass over the bytes. The score
is 1 for a base phrase, else the weight of the best kept rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ladle.llm import common

#: Phrase words -> label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label -> (keyword, name as a regular expression over the words of the text, joined by blanks).
LICENSES = {
    "mit": ("mit|expat|x11", "mit|expat|x11"), "apache-2": ("apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"), "apache-1": ("apache", "apache(?: software)?(?: license)?(?: version)? 1(?: [01])?"),
    "gpl-1": ("gpl|general", "(?:gnu )?(?:gpl|general public license)(?: version)? ?v?1"), "gpl-2": ("gpl|general", "(?:gnu )?(?:gpl|general public license)(?: version)? ?v?2"), "gpl-3": ("gpl|general", "(?:gnu )?(?:gpl|general public license)(?: version)? ?v?3"),
    "lgpl-2": ("lgpl|lesser|library", "(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version)? ?v?2(?: [01])?"), "lgpl-3": ("lgpl|lesser", "(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?v?3"),
    "agpl-3": ("agpl|affero", "(?:gnu )?(?:agpl|affero general public license)(?: version)? ?v?3"), "fdl-1": ("fdl|gfdl|documentation", "(?:gnu )?(?:fdl|gfdl|free documentation license)(?: version)? ?v?1(?: [123])?"),
    "bsd-2": ("bsd|freebsd", "(?:simplified bsd|freebsd|bsd 2(?: clause)?|2 clause bsd)"), "bsd-3": ("bsd", "(?:new bsd|modified bsd|bsd 3(?: clause)?|3 clause bsd)"), "bsd-4": ("bsd", "(?:original bsd|bsd 4(?: clause)?|4 clause bsd)"), "bsd-0": ("0bsd|bsd", "(?:0bsd|zero clause bsd)"),
    "isc": ("isc", "isc"), "zlib": ("zlib", "zlib(?: libpng)?"), "libpng": ("libpng", "libpng(?: 2)?"), "unlicense": ("unlicense", "unlicense"), "wtfpl": ("wtfpl", "wtfpl"), "beerware": ("beerware|beer", "beer ?ware"),
    "mpl-1": ("mozilla|mpl", "(?:mozilla public license|mpl)(?: version)? ?v?1(?: [01])?"), "mpl-2": ("mozilla|mpl", "(?:mozilla public license|mpl)(?: version)? ?v?2(?: 0)?"),
    "epl-1": ("eclipse|epl", "(?:eclipse public license|epl)(?: version)? ?v?1(?: 0)?"), "epl-2": ("eclipse|epl", "(?:eclipse public license|epl)(?: version)? ?v?2(?: 0)?"),
    "cddl-1": ("cddl|distribution", "(?:common development and distribution license|cddl)(?: version)? ?v?1(?: [01])?"), "cpl-1": ("common|cpl", "(?:common public license|cpl)(?: version)? ?v?1(?: 0)?"),
    "eupl-1": ("eupl|european", "(?:european union public licen[cs]e|eupl)(?: version)? ?v?1(?: [012])?"), "osl-3": ("osl|open", "(?:open software license|osl)(?: version)? ?v?3(?: 0)?"), "afl-3": ("afl|academic", "(?:academic free license|afl)(?: version)? ?v?3(?: 0)?"),
    "artistic-1": ("artistic", "(?:perl )?artistic(?: license)?(?: version)? ?v?1(?: 0)?"), "artistic-2": ("artistic", "(?:perl )?artistic(?: license)?(?: version)? ?v?2(?: 0)?"), "boost-1": ("boost|bsl", "(?:boost software license|bsl)(?: version)? ?v?1(?: 0)?"),
    "psf-2": ("python|psf", "(?:python software foundation|psf)(?: license)?(?: version)? ?v?2?"), "ruby": ("ruby", "ruby"), "php-3": ("php", "php(?: license)?(?: version)? ?v?3(?: 0[01])?"), "postgresql": ("postgresql", "postgresql"), "openssl": ("openssl", "openssl"), "ncsa": ("ncsa|illinois", "(?:ncsa|university of illinois)"),
    "ofl-1": ("ofl|font", "(?:sil )?(?:open font license|ofl)(?: version)? ?v?1(?: 1)?"), "odbl-1": ("odbl|database", "(?:open database license|odbl)(?: version)? ?v?1(?: 0)?"), "odc-by": ("odc", "odc by"), "pddl": ("pddl", "pddl"),
    "cc0": ("cc0", "cc0(?: 1 0)?"), "cc-by": ("cc|creative", "(?:cc|creative commons) (?:by|attribution)(?! (?:nc|sa|nd|non|share|no))"), "cc-by-sa": ("cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)"),
    "cc-by-nd": ("cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nd|no ?derivatives)"), "cc-by-nc-sa": ("cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)"), "cc-by-nc-nd": ("cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?derivatives)"),
    "cc-by-nc": ("cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)"), "mulan-2": ("mulan", "mulan psl(?: v?2)?"), "bsl-1-1": ("business", "business source license(?: 1 1)?"), "sspl-1": ("sspl|server", "(?:server side public license|sspl)(?: v?1)?"), "elastic-2": ("elastic", "elastic license(?: v?2)?(?: 0)?"),
    "ms-pl": ("microsoft|ms", "(?:microsoft public license|ms pl)"), "ms-rl": ("microsoft|ms", "(?:microsoft reciprocal license|ms rl)"), "apsl-2": ("apsl", "apsl(?: v?2)?(?: 0)?"), "cecill-2": ("cecill", "cecill(?: version)? ?v?2?"), "upl-1": ("upl|universal", "(?:universal permissive license|upl)(?: v?1)?(?: 0)?"), "vim": ("vim", "vim"),
}
#: (priority, weight, template): an exact grant beats a tag, a tag beats a mention.
TEMPLATES = (
    (0, 0.95, r"(?:released|licensed|distributed|available|provided|published)(?: \S+){{0,3}} under (?:the )?(?:terms of )?(?:the )?(?:{name})"),
    (1, 0.95, r"spdx licen[sc]e identifier (?:{name})"),
    (2, 0.9, r"licensed (?:under|as|with) (?:the )?(?:{name})"),
    (3, 0.8, r"(?:{name}) licen[sc]e(?:d)?"),
    (4, 0.8, r"licen[sc]e (?:is |of |the )*(?:{name})"),
    (5, 0.7, r"under (?:the )?(?:{name})"),
)


def rules() -> list[tuple[int, float, str, re.Pattern, re.Pattern]]:
    """(priority, weight, label, keyword, signature), in the order of priority."""
    out = []
    for priority, weight, template in TEMPLATES:
        for label, (keyword, name) in LICENSES.items():
            out.append((priority, weight, label, re.compile(rf"(?<!\S)(?:{keyword})"), re.compile(rf"(?<!\S){template.format(name=name)}(?!\S)")))
    return out


def detect(words: str, ordered: list[tuple[int, float, str, re.Pattern, re.Pattern]]) -> list[tuple[int, int, str, float]]:
    """Kept (start, end, label, weight) over blank-joined words."""
    gate: dict[str, bool] = {}
    found = []
    for rank, (priority, weight, label, keyword, signature) in enumerate(ordered):
        if gate.setdefault(keyword.pattern, keyword.search(words) is not None):
            found += [(priority, m.start() - m.end(), rank, m.start(), m.end(), label, weight) for m in signature.finditer(words)]
    kept: list[tuple[int, int, str, float]] = []
    for _, _, _, start, end, label, weight in sorted(found):
        if not any(s <= start and end <= e for s, e, _, _ in kept):
            kept.append((start, end, label, weight))
    return sorted(kept)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Every rule needs one of these somewhere in the text.
GATE = rb"licen[sc]e|under"
#: Words on each side of a gate word that the rules can see; no signature is longer.
REACH = 24


def _gate(phrases: list[list[str]]) -> re.Pattern:
    """Found in every text that holds one of ``phrases``, by its longest word, or something that a rule can match."""
    return re.compile(b"|".join([GATE, *sorted({re.escape(max(p, key=len).encode()) for p in phrases})]))


def _phrases(words: list[str], phrase: list[str]) -> list[int]:
    at, out = -1, []
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at:at + len(phrase)] == phrase:
                out.append(at)
    except ValueError:
        return out


def _near(words: list[str]) -> list[str]:
    """Stretches of text around the words that may start a detection."""
    out, last = [], -1
    for i, w in enumerate(words):
        if w.startswith(("licen", "under")):
            end = i + 1
            while end < len(words) and words[end] in ("is", "of", "the"):
                end += 1  # "license is the ..." may go on for any number of these
            lo, hi = max(0, i - REACH), min(len(words), end + REACH)
            if out and lo <= last:
                out[-1] = (out[-1][0], max(last, hi))
            else:
                out.append((lo, hi))
            last = out[-1][1]
    return [" ".join(words[a:b]) for a, b in out]


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan(docs: DataFrame, base: dict[str, str] | None = None) -> DataFrame:
    """One row for each document; see the contract of SCHEMA."""
    phrases = [(p.split(), label) for p, label in (base or BASE).items()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered, gate = rules(), _gate([p for p, _ in phrases])
        is_word = np.zeros(256, bool)
        is_word[0x30:0x3A] = is_word[0x61:0x7B] = is_word[0x80:] = True
        for batch in batches:
            ids = batch.column("doc_id")
            for first, end, data, offsets in common.slices(batch, "text"):
                low = common.lower_ascii(data)
                _, _, doc = common.word_spans(low, offsets, is_word)
                counts = np.bincount(doc, minlength=end - first)
                raw = low.tobytes()
                rows = []
                for i in range(end - first):
                    text = raw[offsets[i]:offsets[i + 1]]
                    hits, base_labels, labels, score = [], set(), set(), 0.0
                    if gate.search(text):
                        words = WORD.findall(text.decode("utf-8", "replace"))
                        for phrase, label in phrases:
                            if at := _phrases(words, phrase):
                                hits += at
                                base_labels.add(label)
                        for stretch in _near(words):
                            for _, _, label, weight in detect(stretch, ordered):
                                labels.add(label)
                                score = max(score, weight)
                    rows.append((len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(base_labels)),
                                 ",".join(sorted(base_labels | labels)), 1.0 if hits else score))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.float64())],
                    names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)
