"""URL filters (operator 6): host and path rules, and for the rest a
logistic regression on hashed character n-grams of host and path.

The model is trained from a small labelled URL table (``LABELLED``, or any
table of url and label) by full-batch gradient descent in numpy.  Host and
path n-grams have buckets of their own; each part's n-grams are scaled to
unit length, so a long path doesn't outvote the host.  Rules are plain rows (action,
host, path): a rule fits its host and all subdomains if the url's path
starts with the rule's path, and the longest fitting rule decides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentflow.llm.ngrams import hashed_ngrams

SIZES = (2, 3, 4, 5)
BITS = 16
CACHE_HOSTS = 100_000
# A path's share against its host's: paths say less.
PATH_SHARE = 0.3

# The small labelled URL table, by topic (gambling, drugs,
# adult, advertising and tracking, link farms, fraud, malware; then plain
# sites of many kinds), independent of the urls that are judged.
BLOCK = """
https://www.luckycasino.test/slots https://casinoroyal.test/bonus http://megacasino777.test/spin http://casino.bestslots.test/jackpot/4
https://poker-stars-online.test/tables http://pokerroom.test/deposit https://livepoker.test/en/bonus http://winbig.test/lottery/claim
https://bigwin-slots.test/play/now http://betting-odds.test/football https://sportsbet365.test/live http://bets4you.test/signup
https://freebet.test/offer/3 http://www.betnow.test/en/odds.html https://roulette-win.test/free https://jackpot-winner.test/claim-prize
http://buy-pills-online.test/order https://pillstore.test/viagra https://discountpills.test/cialis/buy http://cheapmeds.test/no-prescription
https://cheap-drugs.test/pharmacy http://viagra-cheap.test/shop https://weightloss-pills.test/order/2 http://rx-cheap-pharmacy.test/pills
https://hotadult.test/videos http://adult-dating.test/hookup https://www.adultcams.test/live http://xxxvideos.test/free/12
https://sexcam.test/live https://xxx-tube.test/watch http://pornhd.test/clips https://adultfun.test/gallery/x
http://adserver.test/banner?id=3 https://ads.clicknet.test/track https://tracker-pixel.test/collect http://clicktrack.test/redirect
https://trackads.test/impression http://popup-ads.test/click https://adsbanner.test/serve/9 http://track.adnet.test/pixel
http://linkfarm-seo.test/links https://seo-spam.test/backlinks http://spamlinks.test/directory/7 https://buybacklinks.test/cheap
http://spammer-farm.test/list https://contentfarm.test/spin/articles http://doorway-spam.test/keywords https://farm-links.test/exchange
http://secure-login-verify.test/account https://bank-phishing.test/update/password http://verify-paypal-login.test/signin https://prize-claim.test/winner
http://fastcash-loans.test/payday https://payday-loan.test/apply/now http://getrich-quick.test/invest https://free-iphone-winner.test/claim
http://keygen-crack.test/download https://warez-full.test/serial http://malware-dl.test/setup.exe https://cracked-games.test/torrent
""".split()
ALLOW = """
https://www.cityherald.test/news/2021/budget.html http://morningpost.test/world/story-18 https://daily-courier.test/en/opinion https://radio.test/programmes
https://library.test/catalogue/1204 http://archive-society.test/letters/1851 https://museum-of-science.test/en/exhibits/9 https://gallery.test/painters/vermeer
https://physics.uni-north.test/lectures/3 http://college.test/admissions https://school-district.test/calendar.html https://www.mathsclub.test/problems/77
http://blog.slowcooking.test/bread-recipe https://recipes.test/soup/lentil https://www.kitchenbook.test/es/paella http://bakery.test/about
https://garden-notes.test/en/roses http://birdwatch.test/species/heron https://www.riverwalk.test/maps/7.html https://hiking-trails.test/fr/alpes
http://weather-station.test/de/hamburg https://forecast.test/weekly https://m.traintimes.test/departures http://citybus.test/timetable/12
https://docs.compiler.test/manual/intro.html http://opensource-wiki.test/page/threads https://python-howto.test/lists https://code.test/issues/341
https://forum.chessplayers.test/topic/9 http://board.woodwork.test/thread/202?page=3 https://blog.photography.test/lenses https://m.cycling.test/en/gear
http://hospital.test/departments/cardiology https://health-service.test/vaccines https://www.dentist-lane.test/contact http://nutrition.test/fr/guide/5
https://townhall.test/council/minutes http://parliament.test/bills/2020/14 https://court-records.test/en/2019 https://tax-office.test/forms/a1.html
http://football-club.test/fixtures https://athletics.test/results/2022/ https://tennis-news.test/en/7134 http://swimming.test/lessons
https://orchestra.test/concerts http://jazz-history.test/en/1920 https://theatre-royal.test/tickets/44 https://www.filmreview.test/es/2210
https://bookshop.test/novels/88 http://publisher.test/authors/index.html https://poems.test/en/4821 https://shop.toymaker.test/puzzles?page=2
http://bank.test/branches https://insurance.test/en/home https://www.carpenter.test/oak-table http://hotel-lakeside.test/rooms/2
https://anderson.test/en/9012 http://www.wellington.test/de/551.html https://m.horizon.test/fr/3307/ https://thornbury.test/en/18?ref=x
http://blog.northshire.test/es/640#top https://renthaven.test/en/2209?utm_source=feed https://www.steinhof.test/de/7415/ http://bellerive.test/fr/86
""".split()
LABELLED = [(u, 1) for u in BLOCK] + [(u, 0) for u in ALLOW]


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with ``host`` (A-Z lower-cased) and ``path``; both are empty
    without ``://``."""
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)\A([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kept = [c for c in df.columns if c.lower() not in ("host", "path")]
    return df.select(*[F.col(f"`{c}`") for c in kept], lower.alias("host"), path.alias("path"))


def rule_column(rules: list[tuple[str, str, str]], what: str) -> Column:
    """The longest fitting rule's text (``what="rule"``) or action; null if
    none fits.  Of equal length the first of the list wins."""
    out = None
    for action, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        value = F.lit(host + path if what == "rule" else action)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("string") if out is None else out


def features(parts: list[str], salt: int) -> list[np.ndarray]:
    buckets, n = hashed_ngrams(parts, SIZES, BITS - 1, salt)
    buckets = buckets.astype(np.int64) + (salt << (BITS - 1))
    return np.split(buckets, np.cumsum(n)[:-1])


def split_url(url: str) -> tuple[str, str]:
    import re

    rest = url.partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.lower(), re.match(r"[^?#]*", rest[len(host) :])[0]


def train(labelled: list[tuple[str, int]] | None = None, epochs: int = 600, rate: float = 2.0, penalty: float = 1e-4):
    """``(weights, bias)`` from (url, label) rows."""
    rows = [(split_url(u), y) for u, y in (LABELLED if labelled is None else labelled)]
    weights, bias = np.zeros(1 << BITS), 0.0
    if not rows:
        return weights, bias
    y = np.array([r[1] for r in rows], float)
    parts = [(features([p[i] for p, _ in rows], i)) for i in (0, 1)]
    ids = np.concatenate([np.concatenate([a, b]) for a, b in zip(*parts, strict=True)])
    owner = np.repeat(np.arange(len(rows)), [len(a) + len(b) for a, b in zip(*parts, strict=True)])
    value = np.concatenate([np.concatenate([np.full(len(a), len(a) ** -0.5), np.full(len(b), PATH_SHARE * len(b) ** -0.5)]) for a, b in zip(*parts, strict=True)])
    for _ in range(epochs):
        z = np.bincount(owner, value * weights[ids], len(rows)) + bias
        error = 1 / (1 + np.exp(-z)) - y
        gradient = np.bincount(ids, value * error[owner], 1 << BITS) / len(rows)
        weights -= rate * (gradient + penalty * weights)
        bias -= rate * error.mean()
    return weights, bias


def judge(
    df: DataFrame,
    rules: list[tuple[str, str, str]],
    model: tuple[np.ndarray, float],
    url_col: str = "url",
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``score`` (of block) and
    ``verdict`` (``allow`` or ``block``: the rule's, else by score).

    Null urls and urls without ``://`` have an empty host and path, no rule,
    and the score of empty parts.  Repeated rows get equal verdicts; an
    empty table gives an empty one; input columns named like an output are
    replaced."""
    out = ("host", "path", "rule", "score", "verdict")
    base = df.select(*[F.col(f"`{c}`") for c in (keep or df.columns) if c.lower() not in out], F.col(f"`{url_col}`").alias("__url"))
    base = with_parts(base, "__url").drop("__url")
    base = base.withColumn("rule", rule_column(rules, "rule")).withColumn("__action", rule_column(rules, "action"))
    plain = df.sparkSession.sparkContext.broadcast({"weights": model[0].astype(np.float32), "bias": model[1]})
    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        weights, bias = plain.value["weights"], plain.value["bias"]
        hosts: dict[str, float] = {}

        def parts_score(texts: list[str], salt: int) -> list[float]:
            buckets, n = hashed_ngrams(texts, SIZES, BITS - 1, salt)
            if not len(n):
                return []
            at = np.cumsum(n) - n
            return (np.add.reduceat(weights[buckets.astype(np.int64) + (salt << (BITS - 1))], at, dtype=np.float64) * n**-0.5).tolist()

        for batch in batches:
            if len(hosts) > CACHE_HOSTS:
                hosts = {}
            host, path = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            new = [h for h in set(host) if h not in hosts]
            hosts.update(zip(new, parts_score(new, 0), strict=True))
            z = np.array([hosts[h] for h in host]) + PATH_SHARE * np.array(parts_score(path, 1)) + bias
            score = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=schema.names)

    scored = base.mapInArrow(run, schema)
    verdict = F.coalesce("__action", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("__action")
