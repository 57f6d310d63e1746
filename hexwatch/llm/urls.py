"""URL filters: rules, and a logistic regression on hashed character n-grams of host and path (operator 9).

The most specific rule whose host is the url's host or a parent domain of it, and whose path begins the url's path, decides.
Where none fits, a logistic regression decides that is fitted on a small table of labelled urls. Host and path n-grams
are marked, so that the same letters mean different things in either.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule, and is judged by the model's
intercept and the n-grams of empty texts; repeated rows get equal results; an empty table yields no rows; columns of the input named
like results are replaced; hosts and paths of any length are taken whole; a score of exactly one half is `block`.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.llm.common import column

SLOTS = 1 << 14
GRAM_SIZES = (3, 4, 5)
#: Up to so many rules are compiled into one expression, more are looked up by joins on the host's last labels.
MAX_COMPILED_RULES = 200
#: Joined rules of at most so many characters together are broadcast, longer lists are joined by shuffle.
MAX_BROADCAST_CHARACTERS = 32 << 20

#: Fixed values: (verdict, rule) of the query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

#: The labelled table is made by rule: each stem alone and with affixes that say nothing, each in every frame.
BLOCKED_STEMS = (
    "casino poker slots bets betting jackpot gambling pills pharma viagra cialis dietpills spam seo backlinks ads adserver adclick "
    "tracker popup banner porn xxx adult cams dating singles warez cracks keygen torrents payday loans cash forex crypto replica "
    "phish malware botnet"
).split()
ALLOWED_STEMS = (
    "library university museum cityhall news gazette weather garden recipes cooking travel railway atlas history science "
    "physics biology medicine hospital clinic school college teachers students research journal archive books poetry music "
    "theatre cinema photo painting football cycling hiking climate energy forest farming village harbour software python "
    "linux database council parliament justice"
).split()
AFFIXES = "free-{} cheap-{} best-{} online-{} super-{} my-{} the-{} {}-win {}-farm {}-shop {}-track {}-club {}-365 {}-x {}-center {}-now free{} my{} the{} top{} {}hub {}365 {}online {}spot {}box {}bb".split()
#: Neutral invented names: triples of the most frequent English letter pairs.
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le".split()
NEUTRAL_NAMES = [a + b + PAIRS[(i + k) % len(PAIRS)] for k in (1, 3, 7, 11, 13, 19, 23, 27) for i, (a, b) in enumerate(zip(PAIRS, PAIRS[k:] + PAIRS[:k]))]
#: Two pairs with a common ending of English words.
ENDINGS = "tion ness ment ship able ing ish ful less ous ist ity ance ent ly al ic th".split()
NEUTRAL_NAMES += [a + PAIRS[(5 * i + k) % len(PAIRS)] + ENDINGS[(i + 7 * k) % len(ENDINGS)] for k in range(4) for i, a in enumerate(PAIRS)]
FRAMES = (
    "https://www.{name}.example.com/en/{n}", "http://{name}.example.net/fr/{n}.html", "https://blog.{name}.example.org/de/{n}/",
    "http://m.{name}.example.com/es/{n}?page=2&ref=x",
)
#: Ordinary domains: under many top-level domains, of many depths, with the same path words for either label.
TOP_LEVELS = "com org net io de fr es it nl ru co.uk com.br info edu gov club xyz biz tv me".split()
PATH_WORDS = "about contact news products docs articles questions users search category item index help download login profile wiki forum shop 2024".split()
WIDE_FRAMES = (
    "https://{name}.{top}/", "https://www.{name}.{top}/{a}/{n}", "http://{name}.{top}/{a}/{b}-{n}.html?id={n}", "https://{a}.{name}.{top}/{b}/",
)
#: Widely known ordinary and unwanted sites.
ALLOWED_SITES = (
    "github.com/apache/spark stackoverflow.com/questions en.wikipedia.org/wiki/Spark python.org/downloads docs.python.org/3/library apache.org "
    "kernel.org/doc debian.org/releases nasa.gov/missions nature.com/articles arxiv.org/abs who.int/health-topics bbc.co.uk/news lemonde.fr/politique "
    "spiegel.de/wissenschaft elpais.com/cultura nytimes.com/section/world theguardian.com/uk amazon.com/dp ebay.com/itm reddit.com/r/programming "
    "youtube.com/watch vimeo.com/channels medium.com/topic wordpress.org/plugins mozilla.org/firefox microsoft.com/windows apple.com/mac ibm.com/cloud "
    "oracle.com/java mit.edu/research ox.ac.uk/admissions ethz.ch/studium cern.ch/science europa.eu/policies gov.uk/browse imdb.com/title goodreads.com/book "
    "spotify.com/playlist booking.com/hotel bahn.de/reise sncf.fr/voyage weather.gov/forecast paypal.com/help gitlab.com/explore npmjs.com/package"
).split()
BLOCKED_SITES = (
    "888casino.com/live williamhill.com/betting betfair.com/sport 22bet.ru/line melbet.com/slots pokerstars.eu/download partypoker.com/bonus xvideos.com/best "
    "xhamster.com/categories redtube.com/new youporn.com/top livejasmin.com/girls adultfriendfinder.com/go doubleclick.net/ad adnxs.com/tracker "
    "popads.net/click trafficjunky.net/banner thepiratebay.org/torrents 1337x.to/warez keygenguru.com/crack canadianpharmacy.biz/viagra "
    "buycheapcialis.info/order payday-loan-now.com/cash replicawatches.ru/rolex forexprofit.club/signals freebitcoinspin.xyz/win luckyjackpot.club/slots"
).split()
BLOCKED_PATHS = "casino bets poker pills viagra porn xxx adclick track warez keygen payday".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small table of (url, blocked): names in frames of one domain, the same names over many domains, and known sites."""
    rows = []

    def wide(name: str, k: int, blocked: int) -> None:
        top, a, b = TOP_LEVELS[k % len(TOP_LEVELS)], PATH_WORDS[7 * k % len(PATH_WORDS)], PATH_WORDS[3 * k % len(PATH_WORDS)]
        rows.extend((frame.format(name=name, top=top, a=a, b=b, n=13 * k + i), blocked) for i, frame in enumerate(WIDE_FRAMES))

    def add(name: str, k: int, blocked: int) -> None:
        rows.extend((frame.format(name=name, n=17 * k + 31 * i), blocked) for i, frame in enumerate(FRAMES))

    for blocked, stems in ((1, BLOCKED_STEMS), (0, ALLOWED_STEMS)):
        for k, stem in enumerate(stems):
            names = [stem, *(AFFIXES[(k + 5 * i) % len(AFFIXES)].format(stem) for i in range(7))]
            for i, name in enumerate(names):
                add(name, 5 * k + i, blocked)
                wide(name, k + 3 * i, blocked)
    for k, name in enumerate(NEUTRAL_NAMES):
        add(name, k, 0)
        wide(name, k, 0)
    for k, name in enumerate(BLOCKED_PATHS):
        rows += [(f"https://{ALLOWED_STEMS[k]}.example.net/{name}/{k}", 1), (f"https://{ALLOWED_STEMS[k]}.example.net/page/{k}", 0)]
    for blocked, sites in ((0, ALLOWED_SITES), (1, BLOCKED_SITES)):
        for k, site in enumerate(sites):
            host, word = site.split("/")[0], PATH_WORDS[k % len(PATH_WORDS)]
            rows += [(f"https://{site}/{31 * k}", blocked), (f"https://www.{host}/", blocked), (f"http://{host}/{word}/{k}", blocked)]
    return spark.createDataFrame(rows, "url string, blocked int")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case. Path: then up to `?`, `#` or the end."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, parts, 1)), F.regexp_extract(u, parts, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls; of rules of equal length the first listed."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def with_joined_rules(urls: DataFrame, host: str, path: str, rules: list[tuple[str, str]], rule: str, verdict: str) -> DataFrame:
    """As `rule_of`, for lists of any length: one join for each number of labels that rule hosts have, with all rules of a host as one row."""
    spark = urls.sparkSession
    listed = [(text.partition("/")[0], f"/{text.partition('/')[2]}", kind, text, k) for k, (kind, text) in enumerate(rules)]
    table = spark.createDataFrame(listed, "name string, start string, kind string, rule string, place long")
    entry = F.struct(-F.length("rule"), "place", "start", "rule", "kind")  # the longest first, then the first listed
    by_host = table.groupBy("name").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    best = []
    for labels in sorted({name.count(".") + 1 for name, *_ in listed}):
        own, found = f"{rule}_{labels}_name", f"{rule}_{labels}"
        side = by_host.where(F.length("name") - F.length(F.replace("name", F.lit("."))) == labels - 1).select(F.col("name").alias(own), F.col("entries").alias(f"{found}_all"))
        if sum(len(text) for *_, text, _ in listed) <= MAX_BROADCAST_CHARACTERS:
            side = F.broadcast(side)
        urls = urls.join(side, F.substring_index(F.col(host), ".", -labels) == F.col(own), "left")
        urls = urls.withColumn(found, F.get(F.filter(f"{found}_all", lambda e: F.col(path).startswith(e["start"])), F.lit(0))).drop(own, f"{found}_all")
        best.append(found)
    least = F.array_min(F.filter(F.array(*best), lambda e: e.isNotNull()))
    return urls.withColumns({rule: least["rule"], verdict: least["kind"]}).drop(*best)


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each kind with its mark. Numbers in paths count by their length only."""
    def of(mark: str, text: Column) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        sizes = [
            F.transform(F.sequence(F.lit(1), F.greatest(F.length(framed) - n + 1, F.lit(1))), lambda i, n=n: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))))
            for n in GRAM_SIZES
        ]
        return F.concat(*sizes)

    return F.array_distinct(F.concat(of("h", host), of("p", F.regexp_replace(F.lower(path), "[0-9]", "0"))))


def features(urls: DataFrame, host: str, path: str, into: str) -> DataFrame:
    tokens = f"{into}_tokens"
    hashed = HashingTF(inputCol=tokens, outputCol=into, numFeatures=SLOTS, binary=True)
    return hashed.transform(urls.withColumn(tokens, grams(F.col(host), F.col(path)))).drop(tokens)


def fit(labelled: DataFrame) -> LogisticRegressionModel:
    """A model from rows of (url, blocked). Its labels are few, so it is fitted in a few partitions."""
    host, path = host_path(F.col("url"))
    rows = features(labelled.where("blocked is not null").select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("label")), "host", "path", "grams")
    return LogisticRegression(featuresCol="grams", labelCol="label", regParam=0.002, maxIter=60).fit(rows.coalesce(2))


def judged(pages: DataFrame, model: LogisticRegressionModel, rules: list[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """The input's columns with host, path, rule, verdict and score, the model's probability of `block`."""
    new = ("host", "path", "rule", "verdict", "score")
    own = "__u"
    while any(c.startswith(own) for c in pages.columns):
        own = f"_{own}"
    host, path = host_path(column(pages, url))
    names = [c for c in pages.columns if c.lower() not in new]
    rows = pages.select(*(column(pages, c) for c in names), host.alias(f"{own}h"), path.alias(f"{own}p"))
    model = model.copy()
    model.setFeaturesCol(f"{own}f").setProbabilityCol(f"{own}pr").setRawPredictionCol(f"{own}r").setPredictionCol(f"{own}y")
    scored = model.transform(features(rows, f"{own}h", f"{own}p", f"{own}f"))
    if len(rules) <= MAX_COMPILED_RULES:
        rule, verdict = rule_of(F.col(f"{own}h"), F.col(f"{own}p"), rules)
    else:
        scored = with_joined_rules(scored, f"{own}h", f"{own}p", rules, f"{own}l", f"{own}v")
        rule, verdict = F.col(f"{own}l"), F.col(f"{own}v")
    p = vector_to_array(F.col(f"{own}pr"))[1]
    return scored.select(*(column(scored, c) for c in names), F.col(f"{own}h").alias("host"), F.col(f"{own}p").alias("path"), rule.alias("rule"),
                         F.coalesce(verdict, F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"), p.alias("score"))
