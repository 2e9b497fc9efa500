"""URL filter: host and path rules first, else a weighted vocabulary found by Aho-Corasick.

A term counts where no ASCII letter or digit stands next to it. One strict term, or soft_limit distinct soft terms,
reject a URL.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default vocabulary. Pass another as strict and soft.
#: One of these rejects a URL.
STRICT = (
    "adultfriend", "bdsm", "bestiality", "blackjack", "bukkake", "camgirl", "camgirls", "casino", "cumshot", "deepfake", "escort", "escorts", "fetish", "gangbang", "hardcore", "hentai", "incest", "keygen", "malware",
    "milf", "nudes", "orgy", "phishing", "porn", "porno", "pornstar", "ransomware", "rapidgator", "sexcam", "sexchat", "torrentz", "upskirt", "viagra", "voyeur", "warez", "webcamsex", "xrated", "xvideos", "xxx",
)
#: Several distinct ones of these reject a URL.
SOFT = (
    "adult", "affiliate", "bargain", "bet", "bets", "betting", "bingo", "bitcoin", "bonus", "cash", "cheap", "click", "clickbait", "coupon", "coupons", "credit", "crypto", "dating", "deal", "deals", "debt", "diet", "discount", "drugs", "farm", "forex", "free", "gambling", "gratis",
    "hookup", "jackpot", "keto", "loan", "loans", "lottery", "lotto", "mature", "mortgage", "naked", "nude", "payday", "pharmacy", "pills", "poker", "prize", "promo", "referral", "replica", "roulette", "seo", "sex", "sexy", "singles", "slots", "spam", "strip", "sweepstakes", "teen", "torrent", "webcam", "win", "winner",
)
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_CAPITALS = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def cut_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ://."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:]
    stop = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return rest[:end].translate(_CAPITALS), path[:stop]


def build(strict=STRICT, soft=SOFT):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for weight, terms in ((2, strict), (1, soft)):
        for t in terms:
            machine.add_word(t, (t, weight))
    machine.make_automaton()
    return machine


def hits(machine, url: str | None) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of a URL."""
    text = (url or "").translate(_CAPITALS)
    strict, soft = set(), set()
    for end, (term, weight) in machine.iter(text):
        begin = end + 1 - len(term)
        if not (begin and text[begin - 1] in _INNER) and not (end + 1 < len(text) and text[end + 1] in _INNER):
            (strict if weight == 2 else soft).add(term)
    return strict, soft


def filter_urls(pages: DataFrame, strict=STRICT, soft=SOFT, rules=RULES, soft_limit: int = 2, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """pages -> (page_id, host, path, rule, verdict, n_strict, n_soft), one row per input row.

    The longest rule whose host is the URL's or a parent of it and whose path begins the URL's decides (equal
    lengths: the first given); else the vocabulary. A null URL or one without :// has an empty host and path and no
    rule; the vocabulary still reads it. Columns other than the two named are ignored. One map, no shuffle.
    """
    kind = pages.schema[id_col].dataType
    text = T.StringType()
    schema = T.StructType([T.StructField("page_id", kind), T.StructField("host", text), T.StructField("path", text), T.StructField("rule", text), T.StructField("verdict", text), T.StructField("n_strict", T.LongType()), T.StructField("n_soft", T.LongType())])
    ranked = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def judge(batches):
        machine = build(strict, soft)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = cut_url(url)
                bad, doubtful = hits(machine, url)
                rule = next((r for r in ranked if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])), None)
                verdict = rule[2] if rule else "block" if bad or len(doubtful) >= soft_limit else "allow"
                out.append((host, path, rule and rule[0] + rule[1], verdict, len(bad), len(doubtful)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.record_batch([batch.column(0), *[pa.array(c, pa.string()) for c in columns[:4]], *[pa.array(c, pa.int64()) for c in columns[4:]]], names=schema.names)

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).mapInArrow(judge, schema)
