"""Mixing sources to target weights: iterative proportional fitting over source, language and topic, then sampling.

Tokens are summed by cell (source, language, topic). Each sweep scales the cells' shares so that the sources, then the languages, then
the topics have their target shares; after each scaling no cell holds more than all its tokens, so what a full cell cannot give is raked
to the others by the same margins. A document's probability of being taken is its cell's share of the expected tokens, `keep_share` of all, divided by the
cell's tokens, and the document is taken if a uniform number hashed from its id is below that. Everything is DataFrame expressions; the cells stay in Spark.

Targets. Unless given, each marginal's target share is its share of tokens to the power `flatten`, made to sum to 1: 1 keeps the corpus'
mix, 0 makes all categories equal. A target that asks for more tokens than a category has cannot be met without repeating documents: its documents get
probability 1, and what is missing goes to the others by their targets. `margins` reports, for each category, target, what is attainable and what the
probabilities give. Probabilities are rounded to 9 digits, so that they do not depend on the order of sums.

Topic. Without a topic column, a document's topic is that of `vocabulary` with the most occurrences in the whole text: whole words between
characters that are no letter, mark or number, in any case; terms in scripts written without spaces are found anywhere. Ties go to the
first topic, and without an occurrence it is `other`.

Defined cases. Null source, language or topic: a category of its own. Null or empty text: 0 tokens; such documents get probability 1 where
their cell has no tokens, else their cell's. Repeated rows: counted and decided alike. Null id: its number comes from the text. Empty
table: no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land, pick, spread_join


#: Topics and their words: common nouns in English, German, French, Spanish and Russian; then terms of Japanese and Chinese.
VOCABULARY = (
    ("science", "science sciences scientist scientists physics chemistry biology experiment theory molecule galaxy wissenschaft physik chemie biologie experimente theorie forscher"
                " scientifique physique chimie biologie théorie chercheur ciencia científico física química biología teoría наука физика химия биология эксперимент теория ученые",
     "科学 物理 化学 生物学 実験 理論 实验 理论"),
    ("technology", "software computer computers internet database algorithm processor smartphone rechner datenbank algorithmus programmierung ordinateur logiciel algorithme"
                   " ordenador programación algoritmo программа компьютер интернет алгоритм процессор",
     "コンピュータ ソフトウェア インターネット 计算机 软件 互联网 算法"),
    ("health", "health hospital hospitals doctor doctors patient patients disease medicine vaccine surgery gesundheit krankenhaus arzt patienten krankheit medizin impfung"
               " santé hôpital médecin maladie médecine vaccin salud médico enfermedad medicina vacuna здоровье больница врач пациент болезнь медицина",
     "健康 病院 医師 患者 病気 医院 医生 疾病"),
    ("economy", "economy economic market markets bank banks company companies trade inflation investment wirtschaft markt bank unternehmen handel investition"
                " économie marché banque entreprise commerce investissement economía mercado banco empresa comercio inversión экономика рынок банк компания торговля инфляция",
     "経済 市場 銀行 企業 经济 市场 银行 公司"),
    ("politics", "government parliament president minister election elections law court policy regierung parlament präsident wahl wahlen gesetz gericht politik"
                 " gouvernement parlement président ministre élection élections loi gobierno parlamento presidente ministro elecciones ley правительство парламент президент выборы закон суд",
     "政府 国会 大統領 選挙 法律 总统 选举"),
    ("sport", "football soccer basketball tennis olympic champion championship tournament goalkeeper fußball meisterschaft turnier torwart spieler"
              " joueur championnat tournoi équipe fútbol baloncesto campeón campeonato torneo футбол хоккей чемпион турнир команда",
     "サッカー 野球 選手 優勝 足球 篮球 冠军"),
    ("culture", "music film films novel poem poetry theatre museum painting artist musik roman gedicht theater gemälde künstler musique poème théâtre musée peinture artiste"
                " música película novela poema teatro museo pintura artista музыка фильм роман театр музей художник",
     "音楽 映画 小説 美術 音乐 电影 小说"),
    ("nature", "river rivers mountain mountains forest animal animals climate ocean bird birds fluss berge wald tiere klima vögel fleuve rivière montagne forêt animaux climat oiseau"
               " río montaña bosque animales clima océano река гора лес животные климат океан птица",
     "自然 動物 気候 森林 动物 气候 海洋"),
)


@dataclass(frozen=True)
class Params:
    sweeps: int = 12
    flatten: float = 0.7
    keep_share: float = 0.8
    seed: str = "mix"
    #: Topics, their words (lower case, between spaces) and their terms in scripts without spaces.
    vocabulary: tuple[tuple[str, str, str], ...] = VOCABULARY
    #: Up to so many cells (some 200 bytes each) a margin is summed by a window in one task; above, by an aggregate that is joined back.
    window_cells: int = 200_000


MARGINS = ("source", "lang", "topic")


WORD = r"[^\x20\t-\r]+"
APART = r"[^\p{L}\p{M}\p{N}]+"


def terms_pattern(vocabulary: tuple[tuple[str, str, str], ...]) -> str | None:
    """The terms, longer ones first, behind a look at the first character where the engine has it."""
    terms = sorted({t for _, _, terms in vocabulary for t in terms.split()}, key=lambda t: (-len(t), t))
    return "|".join(terms) if terms else None


def topic_of_words(text: Column, vocabulary: tuple[tuple[str, str, str], ...]) -> Column:
    """The topic whose words and terms occur most often."""
    known = sorted({w for _, words, _ in vocabulary for w in words.split()})
    hits = F.filter(F.split(F.lower(text), APART), lambda w: w.isin(known))  # few; counted by topic below
    pattern = terms_pattern(vocabulary)
    if pattern:
        low, high = min(t[0] for t in pattern.split("|")), max(t[0] for t in pattern.split("|"))
        hits = F.concat(hits, F.regexp_extract_all(text, F.lit(f"(?=[{low}-{high}])(?:{pattern})"), F.lit(0)))

    def count(h: Column, i: int) -> Column:
        name, words, terms = vocabulary[i]
        return F.struct(F.size(F.filter(h, lambda w: w.isin([*words.split(), *terms.split()]))).alias("n"), F.lit(-i).alias("rank"), F.lit(name).alias("name"))

    # transform over the one array keeps the words from being split again for every topic
    best = F.transform(F.array(hits), lambda h: F.array_max(F.array(*(count(h, i) for i in range(len(vocabulary))))))[0]
    return F.transform(F.array(best), lambda b: F.when(b["n"] > 0, b["name"]).otherwise("other"))[0]


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topic_col: str | None, p: Params) -> DataFrame:
    """Landed: id, source, lang, topic, n_tokens, text_hash, draw (uniform in [0, 1)); the text is read once."""
    names = {"id": id_col, "text": text_col, "source": source_col, "lang": lang_col} | ({"topic": topic_col} if topic_col else {})
    rows = pick(docs, **names).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("id", F.col("id").cast("long"))
    topic = F.col("topic") if topic_col else topic_of_words(F.col("text"), p.vocabulary)
    key = F.concat(F.lit(p.seed + ":"), F.coalesce(F.col("id").cast("string"), F.concat(F.lit("t"), F.md5("text"))))
    draw = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / float(16**12)
    tokens = F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_tokens")
    return land(rows.select("id", "source", "lang", topic.alias("topic"), tokens, F.xxhash64("text").alias("text_hash"), draw.alias("draw")), "mix-docs")


def _with_sum(table: DataFrame, value: Column, name: str, by: str | None, small: bool) -> DataFrame:
    """table with the sum of value over the rows with the same `by` (over all rows if None)."""
    if small:
        return table.withColumn(name, F.sum(value).over(Window.partitionBy(*([by] if by else [F.lit(1)]))))
    if by is None:  # one row
        return table.crossJoin(F.broadcast(table.agg(F.sum(value).alias(name))))
    sums = table.groupBy(by).agg(F.sum(value).alias(name)).withColumnRenamed(by, "_by")
    # few languages and topics, many sources: copies of the sums keep the rows of a hot category in several tasks
    spread = sums.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(31).cast("bigint"))))
    rows = table.withColumn("_deal", F.pmod(F.xxhash64(*MARGINS), F.lit(32)))
    return rows.join(spread, rows[by].eqNullSafe(spread["_by"]) & (rows["_deal"] == spread["_copy"])).drop("_by", "_copy", "_deal")


def raked(cells: DataFrame, p: Params) -> DataFrame:
    """Landed cells (source, lang, topic, tokens > 0) with target_* (target shares) and weight: bounded fitted shares of the expected tokens."""
    cells = land(cells.where("tokens > 0"), "mix-cells")
    small = cells.count() <= p.window_cells
    one = F.lit(1)
    table = _with_sum(cells, F.col("tokens"), "corpus", None, small)
    table = table.withColumn("cap", F.col("tokens").cast("double") / (F.lit(p.keep_share) * F.col("corpus"))).withColumn("weight", F.col("tokens").cast("double") / F.col("corpus"))
    for m in MARGINS:  # target shares of each margin's categories
        table = _with_sum(_with_sum(table, F.col("tokens"), "mass", m, small), one, "n_cells", m, small).withColumn("mass", F.pow(F.col("mass").cast("double"), F.lit(p.flatten)))
        # Each category once: its mass divided by its number of cells sums to the total over categories.
        table = _with_sum(table, F.col("mass") / F.col("n_cells"), "masses", None, small).withColumn(f"target_{m}", F.col("mass") / F.col("masses")).drop("mass", "masses", "n_cells")
    for sweep in range(p.sweeps):
        for m in MARGINS:
            table = _with_sum(table, F.col("weight"), "total", m, small)
            table = table.withColumn("weight", F.least("cap", F.col("weight") * F.col(f"target_{m}") / F.col("total"))).drop("total")
            if not small:
                table = land(table, "mix-step")
        if small and sweep % 4 == 3:
            table = land(table, "mix-step")  # plans stay short
    # What full cells could not take goes to the others in proportion to their shares, twice over.
    for _ in range(2):
        table = _with_sum(table, F.col("weight"), "total", None, small)
        table = _with_sum(table, F.when(F.col("weight") < F.col("cap"), F.col("weight")).otherwise(0.0), "open", None, small)
        more = F.when((F.col("weight") < F.col("cap")) & (F.col("open") > 0), F.col("weight") * (1 + (1 - F.col("total")) / F.col("open"))).otherwise(F.col("weight"))
        table = table.withColumn("weight", F.least("cap", more)).drop("total", "open")
    rate = F.least(F.lit(1.0), F.round(F.col("weight") / F.col("cap"), 9))
    return land(table.select(*MARGINS, "tokens", *(f"target_{m}" for m in MARGINS), "weight", rate.alias("probability")), "mix-rates")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None, p: Params = Params()) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, sampled, text_hash (xxhash64 of the text) for each row of docs."""
    rows = measured(docs, id_col, text_col, source_col, lang_col, topic_col, p)
    rates = raked(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), p)
    keys = [F.coalesce(F.concat(F.lit("="), m), F.lit("")).alias(f"_{m}") for m in MARGINS]  # null is a category
    found = spread_join(rows.select("*", *keys), rates.select(*keys, "probability"), [f"_{m}" for m in MARGINS], p.window_cells, ["id", "draw"], "left")
    probability = F.coalesce("probability", F.lit(1.0))
    return found.select(F.col("id").alias("doc_id"), *MARGINS, "n_tokens", probability.alias("probability"), (F.col("draw") < probability).alias("sampled"), "text_hash")


def margins(mixed: DataFrame, p: Params = Params()) -> DataFrame:
    """What mix() gives: margin, category, target, attainable (no more than the category has), expected (shares of the expected tokens), met (within 0.01)."""
    mixed = land(mixed.select(*MARGINS, "n_tokens", "probability"), "mix-report")
    total = mixed.agg(F.sum("n_tokens").alias("corpus"), F.sum(F.col("n_tokens") * F.col("probability")).alias("taken"))
    out = None
    for m in MARGINS:
        per = mixed.groupBy(F.col(m).cast("string").alias("category")).agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("expected"))
        mass = F.pow(F.col("tokens").cast("double"), F.lit(p.flatten))
        sums = per.agg(F.sum(mass).alias("masses")).crossJoin(total)  # one row
        rows = per.crossJoin(F.broadcast(sums)).select(
            F.lit(m).alias("margin"), "category", (mass / F.col("masses")).alias("target"),
            F.least(mass / F.col("masses"), F.col("tokens") / (F.lit(p.keep_share) * F.col("corpus"))).alias("attainable"), (F.col("expected") / F.col("taken")).alias("expected"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("met", F.abs(F.col("expected") - F.col("target")) <= 0.01)
