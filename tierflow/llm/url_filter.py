"""URL filter: host and path rules first, else logistic regression on hashed character n-grams.

All of it is DataFrame work: n-grams are array expressions, hashing and the
regression are Spark ML's, fitted on a small labelled URL table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 14
NGRAMS = (3, 4, 5)
# One labelled URL in so many is held out of the regression to set the threshold.
HELD_OUT = 5

# Rules as "host/path start", and the words that labelled hosts are made of.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
BLOCKED_WORDS = {
    "gambling": "casino poker roulette blackjack slots betting sportsbook bingo lottery jackpot wager baccarat",
    "drugs": "viagra cialis pills pharma steroids xanax tramadol dietpills",
    "adult": "porn xxx adult escort sexcam nudes hotgirls milf hookup singles fetish cams",
    "spam": "cheap free winner prize payday loans quickcash replica giveaway spam lose-weight make-money",
    "piracy": "warez torrent crack keygen nulled serials cracked",
    "tracking": "adserver adclick popup popunder tracker banner-ads pixel-track phishing malware clickbait",
}
# What hosts of all kinds add to their words.
ADDED_WORDS = "online club best shop live world zone top hub now 24 direct".split()
# Ordinary hosts: subjects, in four languages; and words that hold a blocked word by chance.
ALLOWED_WORDS = {
    "english": "library garden morning river guide university weather museum health kitchen travel history science forum school parliament theatre music railway bookshop "
    "nature council hospital market village island castle bridge newspaper football cycling photography astronomy physics chemistry economics gazette journal archive "
    "community recipes gardening woodwork knitting sailing climbing walking software developers database network security engineering",
    "german": "garten zeitung schule verein rathaus wetter kirche handwerk wissenschaft geschichte bibliothek stadtwerke sparkasse wanderung kochbuch",
    "french": "maison histoire recettes voyage musique mairie cuisine actualites ecole bibliotheque jardin meteo patrimoine theatre sante",
    "spanish": "noticias cocina ciudad historia escuela ayuntamiento biblioteca jardin tiempo salud deporte universidad gobierno museo teatro",
    "by chance": "cheapside cheese freedom freelance freeman winery windows winter firecracker crackers essex middlesex sussex analysis address adsorption roads "
    "loadstone download pillsbury caterpillars camden cambridge scamper broadcaster popular population trackside racetrack slotted pokeweed prizewinners "
    "pharmacology single-malt adulthood escorial nudge seriously serialisation torrential betterment lotus clickers",
}
PREFIXES = ["", "www.", "blog.", "m."]
DOMAINS = [".com", ".example.com", ".net", ".example.net", ".org", ".example.org", ".test"]
PATHS = ["/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}?page=2&ref=x", "/en/{}#top"]


def labelled() -> list[tuple[str, int]]:
    """The labelled URL table: (url, 1 to block or 0).

    Hosts are words of one kind alone, with an added word before or behind, or in pairs;
    prefixes, domains, added words and paths say nothing about a label.
    """
    rows = []
    for label, kinds in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        words = [w for text in kinds.values() for w in text.split()]
        for i, w in enumerate(words):
            more, other = ADDED_WORDS[i % len(ADDED_WORDS)], words[(i * 7 + 5) % len(words)]
            rows += [(h, label) for h in (w, f"{w}-{more}", f"{ADDED_WORDS[(i + 5) % len(ADDED_WORDS)]}{w}", f"{w}-{other}")]
    return [(f"https://{PREFIXES[i % 4]}{h}{DOMAINS[i % 7]}{PATHS[i % 5].format(i)}", y) for i, (h, y) in enumerate(rows)]


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_col: Column, path_col: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits the host or a domain above it and starts the path; else null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        name, slash, start = r.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith(slash + start)
        found = F.when(fits, F.lit(r)).otherwise(found)
    return found


def _grams(text: Column, mark: str) -> Column:
    """Marked n-grams of a text between < and >."""
    framed = F.concat(F.lit("<"), text, F.lit(">"))

    def of(n: int) -> Column:
        last = F.length(framed) - n + 1
        cut = F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))))
        return F.when(last >= 1, cut).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, NGRAMS))


def features(df: DataFrame, host_col: str, path_col: str) -> DataFrame:
    """Adds __grams: distinct n-grams of the host, and of the path's words of three letters or more.

    Numbers, language codes and marks of a path stand on pages of every kind.
    """
    words = F.regexp_extract_all(F.lower(path_col), F.lit("[^\\x00-\\x60\\x7B-\\x7F]{3,}"), F.lit(0))
    in_path = F.flatten(F.transform(words, lambda w: _grams(w, "p:")))
    return df.withColumn("__grams", F.array_distinct(F.concat(_grams(F.col(host_col), "h:"), in_path)))


@dataclass
class UrlFilter:
    """A fitted pipeline and the probability from which it blocks."""

    model: PipelineModel
    block_at: float

    def scored(self, df: DataFrame, host_col: str, path_col: str) -> DataFrame:
        """Adds score, the probability of block."""
        return self.model.transform(features(df, host_col, path_col)).withColumn("score", vector_to_array("__p")[1])


def _rows(spark: SparkSession, table: list[tuple[str, int]]) -> DataFrame:
    """A small labelled table as host, path and label."""
    values = ", ".join("('{}', {:d}.0D)".format(u.replace("\\", "\\\\").replace("'", "\\'"), y) for u, y in table)
    rows = spark.sql(f"SELECT url, label FROM VALUES {values} AS labelled(url, label)").coalesce(1)
    return rows.select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p"), "label")


def _threshold(scores: list[tuple[float, float]]) -> float:
    """The middle of the widest gap between scores with the most right on both sides, each label counting half."""
    blocked, allowed = sorted(s for s, y in scores if y > 0), sorted(s for s, y in scores if y == 0)
    if not blocked or not allowed:
        return 0.5
    cuts = sorted({0.0, 1.0, *blocked, *allowed})

    def right(cut: float) -> float:
        return sum(s >= cut for s in blocked) / len(blocked) + sum(s < cut for s in allowed) / len(allowed)

    best = max(right((a + b) / 2) for a, b in zip(cuts, cuts[1:], strict=False))
    return max(((b - a, (a + b) / 2) for a, b in zip(cuts, cuts[1:], strict=False) if right((a + b) / 2) == best))[1]


def fit(spark: SparkSession, table: list[tuple[str, int]] | None = None) -> UrlFilter:
    """Learn from a small labelled URL table: (url, 1 to block or 0); every ``HELD_OUT``-th row sets the threshold only."""
    table = labelled() if table is None else table
    held = table[HELD_OUT - 1 :: HELD_OUT]
    rows = features(_rows(spark, [r for i, r in enumerate(table) if i % HELD_OUT != HELD_OUT - 1]), "h", "p")
    stages = [HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__hashed"), Normalizer(inputCol="__hashed", outputCol="__unit")]
    for s in stages:
        rows = s.transform(rows)
    model = LogisticRegression(featuresCol="__unit", labelCol="label", probabilityCol="__p", predictionCol="__y", rawPredictionCol="__raw", regParam=0.0001, maxIter=60, standardization=False).fit(rows)
    fitted = UrlFilter(PipelineModel([*stages, model]), 0.5)
    if held:
        fitted.block_at = _threshold([tuple(r) for r in fitted.scored(_rows(spark, held), "h", "p").select("score", "label").collect()])
    return fitted


def judge(
    df: DataFrame,
    fitted: UrlFilter,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: dict[str, str] | None = None,
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, score (probability of block by the regression).

    A null url or one without :// has an empty host and path, which no rule fits;
    the regression judges it like any other. Rows are judged one by one. rules are
    few (each is an expression of the plan), their hosts in lower case.
    """
    url = F.col(url_col).cast("string")
    rows = df.select(F.col(id_col).alias("__id"), host(url).alias("host"), path(url).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules))
    verdict = F.when(F.col("score") >= fitted.block_at, "block").otherwise("allow")
    for r, v in (RULES if rules is None else rules).items():
        verdict = F.when(F.col("rule") == r, F.lit(v)).otherwise(verdict)
    return fitted.scored(rows, "host", "path").select(F.col("__id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
