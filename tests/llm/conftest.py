import random

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

COLUMNS = [("doc_id", LongType()), ("text", StringType()), ("lang", StringType()), ("source", StringType()),
           ("n_chars", LongType())]
#: Columns whose names the operators use themselves.
CLASHING = ["id", "row", "key", "size", "shard", "slot", "kept", "start", "end", "n", "doc", "w", "cell", "carried",
            "words", "score", "component", "of", "raw", "spans", "host", "grp", "row_"]

SYLLABLES = {
    "en": ["the", "and", "ing", "ou", "th", "er", "wh", "ly", "tion"],
    "de": ["der", "ung", "sch", "keit", "ü", "ß", "ein", "zu", "pf"],
    "fr": ["é", "eux", "ment", "que", "ç", "elle", "ou", "dans", "è"],
}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def make_rows(seed=1, n=60):
    """Invented documents with copies, near copies, shared passages, edges and secrets."""
    rng = random.Random(seed)
    rows = []
    passage = prose(rng, "en", 60)
    base = {lang: prose(rng, lang, 120) for lang in SYLLABLES}
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        kind = i % 6
        text = prose(rng, lang, rng.randint(1, 200))
        if kind == 1:
            words = base[lang].split(" ")
            words[rng.randrange(len(words))] = "edit" + str(i)
            text = " ".join(words)
        elif kind == 2:
            text = prose(rng, lang, 30) + "\n" + passage + "\n" + prose(rng, lang, 30)
        elif kind == 3:
            text = base[lang].replace(" ", "  " if i % 2 else "\n")
        elif kind == 4:
            text = text + "\nline again\nline again\n" + f'api_key = "{"k%d" % (i % 3)}abcdef1234" AKIA{"Q" * 16}{i} ' \
                + f"{'0123456789abcdef' * 2}{i:x} token: token:abcdefgh ###"
        rows.append((i * 7 % 1000, text, lang if i % 9 else None, f"src{i % 4}" if i % 11 else None, len(text)))
    text = "Un " * 400 + "fin. " + prose(rng, "fr", 5000)
    rows += [(900, None, "en", "src0", 0), (901, "", "en", "src0", 0), (902, " \t\r\n", "de", None, 4),
             (903, "1234 56!!", None, "src1", 9), (904, text, "fr", "src2", len(text)),
             (905, text, "fr", "src2", len(text)), (906, "😀 漢字 ​ x x", "fr", "src3", 9),
             (907, "a b c", "en", "src1", 5), (908, "A B  C", "en", "src1", 6), (909, "$0 \\1 '\" x", None, "src3", 20)]
    rows += [rows[8], rows[8], rows[-1]]  # repeated rows
    return rows


def frame(spark, rows, clashing=False):
    schema = StructType([StructField(n, t) for n, t in COLUMNS])
    df = spark.createDataFrame(rows, schema)
    if clashing:
        from pyspark.sql import functions as F
        for c in CLASHING:
            df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def unique_rows(rows):
    """One row per id, as the SQL of the queries expects."""
    return list({r[0]: r for r in rows}.values())


@pytest.fixture(scope="session")
def table(spark, rows, tmp_path_factory):
    """A folder with the documents (repeated rows included)."""
    path = str(tmp_path_factory.mktemp("sf"))
    frame(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="session")
def unique_table(spark, unique_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sfu"))
    frame(spark, unique_rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path
