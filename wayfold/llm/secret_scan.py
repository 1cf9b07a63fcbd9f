"""Secret scans: candidates by pattern, false positives removed by a random forest;
DataFrame operations only (the forest is Spark's own and runs in the JVM).

A candidate is what follows an assigning name (password, token, key and the like), of
any length and any characters: all between quotes, or else up to the next space or
quote without a stop or bracket at its end. Elsewhere it is a run of at least
MIN_LENGTH characters as keys use them, with a digit. The forest sees its length, how
its characters change between kinds, how much of it words of a public vocabulary cover,
whether it stands in a path or address, and the words beside it. Which words beside a
candidate speak for a secret isn't written down anywhere: each word's log odds are
learned from one half of the labelled findings, and the forest from the other half.

The model is trained from labelled findings, ``context before, candidate, context
after, label``. No table holds any, so :func:`labelled_findings` makes them by a fixed
protocol: a finding is a context, a name, a sign between and a value, each drawn from a
list by a hash. Every third entry of each list is kept apart: findings for training never
draw it, and findings of the held-out set draw nothing else, so that precision and recall
are measured on names, contexts and shapes of values that the model hasn't seen. Any table
of the same columns takes their place.

Defined results: null text counts as empty; texts without a candidate give no row;
rows that repeat an id give their findings again; null ids are carried; candidates and
texts have no upper length; other columns of the input, whatever their names, aren't
looked at (but :func:`redacted` keeps them); an empty table gives an empty table.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key

MIN_LENGTH = 16
#: One character of a run, the names that assign, and a name with what stands between it and its value.
CHAR = r"[A-Za-z0-9+/=_\-]"
NAME = r"(?i:token|secret|passw|passphrase|pwd|api[_\- ]?key|access[_\- ]?key|auth(?!or)|credential|bearer|private[_\- ]?key)"
_NAMED = NAME + r"""[A-Za-z0-9_\-]{0,16}["'`]?\s{0,3}(?:=>|:=|[:=]|\bis\b)?\s{0,3}"""
_VALUE = "|".join([*[rf"(?<={q})(?:[^{q}\s]+|[^{q}\n]{{1,128}})(?={q})" for q in "\"'`"], r"(?<=[\s=:>])[^\s\"'`]*[^\s\"'`.,;:)\]}>]"])
#: A whole run that holds a digit; a candidate: a value (looked for only behind a space, a
#: quote or a sign), or a run that doesn't itself assign a value.
RUN = rf"(?<!{CHAR})(?={CHAR}*[0-9]){CHAR}{{{MIN_LENGTH},}}"
CANDIDATE = rf"(?<=[\s\"'`=:>])(?![\s=:>])(?<=(?=[tspabcTSPABC]){_NAMED}[\"'`]?)(?:{_VALUE})|(?<!{CHAR})(?={CHAR}*[0-9])(?![A-Za-z0-9_\-]{{0,32}}?{NAME}[A-Za-z0-9_\-]{{0,16}}=[^=\s]){CHAR}{{{MIN_LENGTH},}}"
#: Characters of context on each side.
BEFORE, AFTER = 48, 24
TREES, DEPTH, SEED = 40, 7, 7
#: Words before a candidate that are looked at, and findings that a word needs.
NEAR, MIN_SEEN = 6, 3
EXPLICIT = r"""(=>|[:=])\s*["'`]?$"""

FEATURES = {
    "length": "least(length(c), 256)",
    "digits": "length(regexp_replace(c, '[^0-9]', '')) / length(c)",
    "upper": "length(regexp_replace(c, '[^A-Z]', '')) / length(c)",
    "lower": "length(regexp_replace(c, '[^a-z]', '')) / length(c)",
    "other": "length(regexp_replace(c, '[A-Za-z0-9]', '')) / length(c)",
    "hex": "if(c rlike '^[0-9a-fA-F]+$', 1.0, 0.0)",
    "changes": "length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, '[0-9]+', '9'), '[A-Z]+', 'A'), '[a-z]+', 'a'), '[^9Aa]+', '.')) / length(c)",
    "distinct": "size(array_distinct(split(c, ''))) / least(length(c), 64)",
    "dictionary": "aggregate(filter(parts, p -> contains_word(p)), 0, (n, p) -> n + length(p)) / length(c)",
    "uuid": "if(c rlike '(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$', 1.0, 0.0)",
    "slashes": "size(split(c, '/')) - 1",
    "address": "if(b rlike '(://|www[.]|[/.@#?&])\\\\S*$' OR a rlike '^[/.@]\\\\w', 1.0, 0.0)",
    "quoted": """if(b rlike '["\\'`]$' AND a rlike '^["\\'`]', 1.0, 0.0)""",
    "explicit": "if(b rlike {explicit}, 1.0, 0.0)",
    "word": "coalesce(element_at(odds, -1), 0)",
    "word_before": "if(size(odds) > 1, odds[size(odds) - 2], 0)",
    "words_for": "greatest(array_max(odds), 0)",
    "words_against": "least(array_min(odds), 0)",
    "letters": "if(c rlike '^[A-Za-z]+$', 1.0, 0.0)",
    "vowels": "length(regexp_replace(lower(c), '[^aeiou]', '')) / length(c)",
    "template": "if(c rlike '^[<$%]|[({]|^[*x.]+$', 1.0, 0.0)",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def public_words() -> list[str]:
    """Lower-case words of four letters or more that a public tokenizer has as one piece."""
    import public_tokenizers as public

    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    return sorted({p[1:] for p in pieces if len(p) > 4 and p[0] == "Ġ" and p[1:].isascii() and p[1:].isalpha() and p[1:].islower()})


def _constant(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


#: The words of a context, in lower case; names are taken apart.
WORDS = r"filter(split(lower(regexp_replace({}, '([a-z])([A-Z])', '$1 $2')), '[^a-z0-9]+'), w -> length(w) > 1)"


@dataclass
class SecretModel:
    """A forest, the log odds of the words beside a candidate, and the dictionary."""

    forest: RandomForestClassificationModel | None
    odds: dict[str, float]
    dictionary: list[str]

    def with_features(self, found: DataFrame) -> DataFrame:
        """Adds ``features`` to rows of ``b, c, a`` (context before, candidate, after)."""
        held = defaultdict(list)  # by their first letters, so that a look-up is short
        for word in self.dictionary:
            held[word[:3]].append(word)
        found = found.withColumns({"dictionary_words": _constant(held, "map<string, array<string>>"), "word_odds": _constant(self.odds or {"": 0.0}, "map<string, double>")})
        parts = WORDS.format("c").replace("length(w) > 1", "length(w) > 3")
        odds = f"transform(slice(reverse({WORDS.format('b')}), 1, {NEAR}), w -> coalesce(try_element_at(word_odds, w), 0D))"
        found = found.withColumns({"parts": F.expr(parts), "odds": F.expr(f"if(size({WORDS.format('b')}) = 0, array(0D), reverse({odds}))")})
        is_word = "coalesce(array_contains(try_element_at(dictionary_words, left(p, 3)), p), false)"
        sql = {k: v.replace("{explicit}", _quoted(EXPLICIT)).replace("contains_word(p)", is_word) for k, v in FEATURES.items()}
        found = found.withColumns({f"f_{k}": F.expr(f"cast({v} as double)") for k, v in sql.items()})
        assembler = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
        return assembler.transform(found).drop(*[f"f_{k}" for k in FEATURES], "parts", "odds", "dictionary_words", "word_odds")

    def scored(self, found: DataFrame) -> DataFrame:
        """Adds ``score``, the forest's share of votes for a secret."""
        out = self.forest.transform(self.with_features(found))
        return out.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def labelled_findings(spark: SparkSession, rows: int = 6_000, held_out: bool = False) -> DataFrame:
    """``b, c, a, label``: findings by the protocol above, half of them secrets."""
    hexed = f"sha2(concat('{'held' if held_out else 'train'}', id), 512)"
    b64 = f"translate(base64(unhex({hexed})), '=', '')"

    def pick(key: str, options: list[str]) -> str:
        own = [x for k, x in enumerate(options) if (k % 3 == 2) == held_out]
        return f"element_at(array({', '.join(own)}), 1 + cast(pmod(xxhash64('{key}', id), {len(own)}) as int))"

    def texts(line: str) -> list[str]:
        return [f"'{x}'" for x in line.split("|")]

    letters = f"translate({b64}, '0123456789+/', 'kQwZbXvJgHpT')"
    word = pick("o", texts("dragon|Summer|Autumn|sunshine|hunter|Phoenix|Winter|monkey|Secure|qwerty|Tr0ub|Welcome"))
    digits = f"translate(substring({hexed}, 7, 3), 'abcdef', '123456')"
    cut = lambda text, *at: [f"substring({text}, {x})" for x in at]
    secret = pick(
        "s",
        [
            *cut(hexed, "1, 40", "1, 32", "1, 56", "1, 64", "1, 48"),
            f"concat('xoxb-', {digits}, '-', substring({b64}, 1, 24))",
            f"concat('AKIA', upper(substring({hexed}, 1, 16)))",
            f"concat('ghp_', substring({b64}, 3, 36))",
            f"concat('AIza', substring({b64}, 5, 35))",
            f"concat('sk-', substring({hexed}, 5, 48))",
            *cut(b64, "1, 40", "1, 30", "1, 24", "1, 10"),
            f"concat(substring({b64}, 1, 4), '#', substring({b64}, 9, 5), '%')",
            f"concat(substring({b64}, 1, 5), '!', substring({b64}, 7, 4))",
            f"concat(substring({b64}, 1, 3), '$', substring({b64}, 7, 5), '.', substring({b64}, 21, 6), '@')",
            f"substring({letters}, 1, 14)",
            *cut(letters, "1, 20", "1, 10"),
            f"concat({digits}, {word}, {digits})",
            f"concat({word}, {digits})",
            f"concat({word}, {digits}, '!')",
            f"concat({word}, {digits}, '?')",
            f"concat({word}, 'dor', substring({digits}, 1, 1))",
        ],
    )
    named = pick("n", texts("token|api_key|access_token|secret|password|db_password|access_key|auth_token|private_key|client_secret|API-KEY|apiKey|credentials|pwd|user passwd|DB_PASSWORD|my password|auth token|secret key"))
    joined = pick("j", ["' = \"'", "'=\"'", "'='", "': \"'", "' = '", "' := \"'", "': '", "' is '", "'\": \"'", "\" = '\"", "' '", "' => \"'"])
    harmless = pick(
        "h",
        [
            *cut(hexed, "1, 40", "1, 64", "1, 56", "1, 32"),
            f"concat_ws('-', substring({hexed}, 1, 8), substring({hexed}, 9, 4), substring({hexed}, 13, 4), substring({hexed}, 17, 4), substring({hexed}, 21, 12))",
            f"concat('long/path/of/', id, '/', substring({hexed}, 1, 12))",
            f"translate(substring({hexed}, 1, 18), 'abcdef', '123456')",
            f"concat('some_long_identifier_', substring({hexed}, 1, 2), '_2')",
            f"translate(substring({hexed}, 1, 16), 'abcdef', '987654')",
            "concat('usr/lib/python3/site-packages/', id)",
            "concat('your-api-key-here-', id)",
            "concat('column-name-of-table-', id % 100)",
            "concat('xxxxxxxxxxxxxxxx', id % 10)",
            f"concat('thathererin', translate(substring({hexed}, 1, 12), '0123456789', 'aeinorstlh'), id % 10)",
            "concat('figure-caption-number-', id)",
        ],
    )
    told = pick("t", texts("commit |sha256:|revision |md5 |id: |etag: |phone |see |account |/|https://example.org/|www.example.com/|call |checksum = |digest: |order no. |, |uuid "))
    # a random value after a secret's name would be a secret; there only made-up values are harmless
    fake = pick("f", ["concat('your-api-key-here-', id)", "concat('xxxxxxxxxxxxxxxx', id % 10)", "'<password>'", "concat('example-token-value-', id % 1000)", "concat('changeme-changeme-', id % 100)", "'your-password'", "'changeme'", "'********'", "'${DB_PASSWORD}'", "'<your-token>'", "concat('${TOKEN_', id % 10, '}')", "'getenv(SECRET)'", "'os.environ[KEY]'", "'get_password()'", "'xxxx'"])
    # plain words follow a name in prose and in code
    plain = pick("p", texts("required|string|missing|null|None|empty|true|reset|changed|field|the|for|not|of|with|and|economy|policy|management|garden|manager|service|must|bytes|expired|was|value|invalid|authentication|stored|optional|str|strong|John|gratitude|forgotten"))
    loose = pick("l", texts(" | is |: is | : | for |: | = "))
    words = pick("w", texts("the value of |in this file the |here is the |export |and so ||use |with a |let |here |the "))
    end = pick("e", ["'\"'", "'\" and more'", "'\";'", "' then'", "''", "'.'", "'. Next'", "' there'"])
    out = spark.range(rows).withColumn("label", F.expr("cast(id % 2 as double)")).withColumn("told", F.expr(told))
    out = out.withColumn("mock", F.expr("pmod(xxhash64('m', id), 6)"))  # of the harmless ones: 0 made up, 1 and 2 plain words
    b = F.expr(f"concat({words}, case when label = 1 or mock = 0 then concat({named}, {joined}) when mock < 3 then concat({named}, {loose}) else told end)")
    c = F.expr(f"case when label = 1 then {secret} when mock = 0 then {fake} when mock < 3 then {plain} else {harmless} end")
    return out.select("id", b.alias("b"), c.alias("c"), F.expr(end).alias("a"), "label")


def train(findings: DataFrame, dictionary: list[str] | None = None) -> SecretModel:
    """A model from labelled findings, which should be a bounded set: the odds of words
    from one half of them, by a hash, and the forest from the other."""
    half = F.pmod(F.xxhash64("b", "c", "a"), F.lit(2))
    words = findings.where(half == 0).select(F.explode(F.array_distinct(F.expr(f"slice(reverse({WORDS.format('b')}), 1, {NEAR})"))).alias("w"), "label")
    words = words.groupBy("w").agg(F.sum("label").alias("for_"), F.sum(1 - F.col("label")).alias("against")).where(F.col("for_") + F.col("against") >= MIN_SEEN)
    odds = {r["w"]: math.log((r["for_"] + 0.5) / (r["against"] + 0.5)) for r in words.collect()}
    model = SecretModel(None, odds, public_words() if dictionary is None else dictionary)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    model.forest = forest.fit(model.with_features(findings.where(half == 1)).select("features", "label").coalesce(1))
    return model


def quality(model: SecretModel, findings: DataFrame) -> dict[str, float]:
    """Precision and recall on labelled findings."""
    hit = F.col("score") >= 0.5
    row = model.scored(findings).agg(F.count_if(hit).alias("found"), F.count_if(hit & (F.col("label") == 1)).alias("right"), F.sum("label").alias("secrets")).first()
    return {"precision": row["right"] / max(row["found"], 1), "recall": row["right"] / max(row["secrets"], 1)}


def _taken_apart(text: Column) -> tuple[Column, Column]:
    """The candidates of a text and the pieces between them. Texts without an
    assigning name have runs only, for which the short pattern does."""
    named = text.rlike(NAME)
    found = F.when(named, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)))
    return found, F.when(named, F.split(text, CANDIDATE, -1)).otherwise(F.split(text, RUN, -1))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, k, b, c, a``: the k-th candidate of a text (from 0) and its context."""
    own = docs.select(F.col(id_col), F.col(text_col).alias("__wf_text")).where(F.col("__wf_text").rlike(f"{NAME}|{RUN}"))
    found, pieces = _taken_apart(F.col("__wf_text"))
    own = own.select(id_col, found.alias("cs"), F.transform(pieces, lambda p: F.struct(F.right(p, F.lit(BEFORE)).alias("r"), F.left(p, F.lit(AFTER)).alias("l"))).alias("ps"))
    own = own.select(id_col, F.expr("inline(transform(cs, (c, i) -> struct(i as k, ps[i].r as b, c as c, ps[i + 1].l as a)))"))
    return own


def scan(docs: DataFrame, model: SecretModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, k, candidate, score, is_secret`` of every candidate."""
    model = model or train(labelled_findings(docs.sparkSession))
    found = model.scored(candidates(docs, id_col, text_col))
    return found.select(id_col, "k", F.col("c").alias("candidate"), "score", (F.col("score") >= 0.5).alias("is_secret"))


def redacted(docs: DataFrame, model: SecretModel | None = None, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret replaced; all rows and columns stay. Rows with one id
    and different texts are different documents."""
    key = row_key(id_col, text_col)
    keyed = docs.select(key.alias("__wf_key"), F.col(text_col).alias(text_col))
    found = scan(keyed, model, "__wf_key", text_col).where("is_secret").groupBy("__wf_key").agg(F.collect_set("k").alias("__wf_k"))
    found = found.select(F.col("__wf_key.id").alias("__wf_id"), F.col("__wf_key.hash").alias("__wf_hash"), "__wf_k")
    out = docs.join(found, F.col(id_col).eqNullSafe(F.col("__wf_id")) & (key["hash"] == F.col("__wf_hash")), "left")
    cs, ps = _taken_apart(F.col(text_col))
    between = F.transform(cs, lambda c, i: F.when(F.array_contains(F.col("__wf_k"), i), F.lit(mark)).otherwise(c))
    parts = F.zip_with(ps, F.concat(between, F.array(F.lit(""))), lambda p, c: F.concat(p, c))
    text = F.when(F.col("__wf_k").isNull(), F.col(text_col)).otherwise(F.array_join(parts, ""))
    return out.withColumn(text_col, text).drop("__wf_id", "__wf_hash", "__wf_k")
