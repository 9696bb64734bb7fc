"""URL filter: site rules first, then a weighted vocabulary searched with an Aho-Corasick automaton.

A term counts where it stands between boundaries: no letter touches it. One strict term rejects an address; so do soft
terms whose weights, each distinct term once, add up to the threshold. Rules name a site and a path and override that.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.tables import lowered

# Strict terms, and soft terms with their weights: 1.5 for words that mostly name what is not wanted, 1 for words that
# often do, 0.75 and 0.5 for everyday words that tell only beside others. English, German, French and Spanish. A caller brings its own.
STRICT = [
    "porn", "porno", "xxx", "hentai", "escort", "escorts", "camgirl", "camgirls", "viagra", "cialis", "warez", "phishing", "malware", "spam",
    "pornos", "sexfilme", "pornographie", "pornografia",
]
SOFT = {
    "adult": 1.5, "sex": 1.5, "nude": 1.5, "erotik": 1.5, "erotique": 1.5, "erotico": 1.5, "casino": 1.5, "poker": 1.5, "bets": 1.5, "betting": 1.5,
    "jackpot": 1.5, "wetten": 1.5, "paris-sportifs": 1.5, "apuestas": 1.5, "keygen": 1.5, "torrent": 1.5, "replica": 1.5,
    "bet": 1.0, "slots": 1.0, "pills": 1.0, "pharmacy": 1.0, "apotheke": 1.0, "pharmacie": 1.0, "farmacia": 1.0, "drugs": 1.0, "cheap": 1.0, "billig": 1.0,
    "barato": 1.0, "crack": 1.0, "hacks": 1.0, "ads": 1.0, "track": 1.0, "tracker": 1.0, "popup": 1.0, "dating": 1.0, "singles": 1.0, "loans": 1.0, "kredit": 1.0,
    "loan": 0.75, "bonus": 0.75, "click": 0.75, "farm": 0.5, "free": 0.5, "gratis": 0.5, "gratuit": 0.5, "win": 0.5, "gewinn": 0.5, "gagner": 0.5, "ganar": 0.5,
}
SOFT_LIMIT = 2.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null and where ``://`` is missing."""
    return lowered(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Vocabulary:
    """Strict and weighted soft terms behind one automaton."""

    def __init__(self, strict, soft: dict[str, float], limit: float):
        import ahocorasick

        self.limit = limit
        self.automaton = ahocorasick.Automaton()
        for term, weight in [*soft.items(), *((t, None) for t in strict)]:
            self.automaton.add_word(term.lower(), (term.lower(), weight))
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def judge(self, text: str) -> tuple[str, str | None, float]:
        """(verdict, first strict term, weight of the distinct soft terms)."""
        text = text.lower()
        soft: dict[str, float] = {}
        for end, (term, weight) in [] if self.empty else self.automaton.iter(text):
            start = end - len(term)
            if (start >= 0 and text[start].isalpha()) or (end + 1 < len(text) and text[end + 1].isalpha()):
                continue
            if weight is None:
                return "block", term, sum(soft.values())
            soft[term] = weight
        total = sum(soft.values())
        return ("block" if total >= self.limit else "allow"), None, total


def find_rule(by_host: dict[str, list[Rule]], host: str, path: str) -> Rule | None:
    """The longest rule that fits: by the host or a domain above it, and by a path that the address's starts with."""
    best = None
    name = host
    while name:
        for rule in by_host.get(name, ()):
            if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                best = rule
        name = name.partition(".")[2]
    return best


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT, limit: float = SOFT_LIMIT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``strict_term`` and ``soft_weight``.

    Columns of these names that ``pages`` has are replaced. Null addresses and addresses without ``://`` have an empty host
    and path, no rule, and the vocabulary's verdict on the whole text (null: ``allow``). Ties between rules of one length:
    the one listed first. A name such as ``a..org`` has an empty part; domains above it are tried all the same.
    """
    rules = list(rules)

    def step(batches):
        words = Vocabulary(strict, soft, limit)
        by_host: dict[str, list[Rule]] = {}
        for rule in rules:
            by_host.setdefault(rule.host, []).append(rule)
        for batch in batches:
            hosts, paths, urls = (c.to_pylist() for c in batch.columns[-3:])
            found = [find_rule(by_host, h, p) for h, p in zip(hosts, paths)]
            said = [words.judge(u or "") for u in urls]
            extra = [
                pa.array([r and r.text for r in found], pa.string()),
                pa.array([r.verdict if r else s[0] for r, s in zip(found, said)], pa.string()),
                pa.array([s[1] for s in said], pa.string()),
                pa.array([s[2] for s in said], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *extra], names=names)

    made = ["host", "path", "rule", "verdict", "strict_term", "soft_weight"]
    held = [c for c in pages.columns if c not in made]
    url = F.col(url_col).cast("string")
    asked = pages.select(*held, host_of(url).alias("host"), path_of(url).alias("path"), url.alias("_url"))
    schema = asked.drop("_url").schema.add("rule", "string").add("verdict", "string").add("strict_term", "string").add("soft_weight", "double")
    names = schema.fieldNames()
    return asked.mapInArrow(step, schema)
