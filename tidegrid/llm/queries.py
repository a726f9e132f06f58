"""The corpus operators as queries over the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import alignment, chat, decontaminate, htmltext, jaccard, langid, mixture, neighbours, ranked, secrets, substrings, tokencount, tokenfiles
from tidegrid.llm import sqltext as sql
from tidegrid.llm.scratch import table
from tidegrid.session import configure, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
SECOND_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def query(name: str, text: str | None = None):
    """Register a function of (spark, sf_dir)."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if text is not None:
            SQL[name] = text
        return run

    return add


def load():
    return dict(QUERIES), dict(SQL)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_jaccard_components", sql.jaccard(3, 90))
def op1(spark, sf_dir):
    """Documents and the components of their links by shared three-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents", ["doc_id", "text"]), k=3, percent=90)


@query("op2_token_counts")
def op2(spark, sf_dir):
    """Bytes and tokens of every document."""
    counts = tokencount.count_tokens(table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op3_decontaminate", sql.DECONTAMINATE)
def op3(spark, sf_dir):
    """Words of every document that lie in a benchmark window, and the items found."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query("op4_html_text")
def op4(spark, sf_dir):
    """Visible text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages", ["page_id", "html"]))


@query("op5_mix_sources", sql.MIX)
def op5(spark, sf_dir):
    """Words that the mix takes of every document."""
    mixed = mixture.mix(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_substring_dedup", sql.remove_repeats(50))
def op6(spark, sf_dir):
    """Documents without the 50-word windows that also start in an earlier document."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents", ["doc_id", "text"]), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_nearest_neighbours")
def op7(spark, sf_dir):
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), k=20, every=20)


@query("op8_chat_format", sql.chat_format(chat.LLAMA))
def op8(spark, sf_dir):
    """Every conversation formatted, and what is read back from the output."""
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', :said), (-7L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)", args={"said": said})
    back = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), chat.turn_digest(F.col("turns")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


@query("op9_language")
def op9(spark, sf_dir):
    """Predicted language of every document, by a model trained on the documents not held out."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


@query("op10_token_files")
def op10(spark, sf_dir):
    """Every document as token ids, written to files and read back from them."""
    folder = shared_dir(spark, "token-files")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents", ["doc_id", "text"]), folder, tokenizer_path())
    return tokenfiles.read_token_files(spark, folder)


@query("op11_align_tokens")
def op11(spark, sf_dir):
    """Groups of two tokenizers' tokens over every document, and the counts of what they link."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = alignment.align(docs, tokenizer_path(), tokenizer_path(SECOND_TOKENIZER))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return alignment.score_links(found.withColumn("groups_sha256", digest).drop("groups"))


@query("op12_secret_scan", sql.secret_scan())
def op12(spark, sf_dir):
    """Secrets in every document, and the weak candidates that complement each other."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in secrets.BASE], F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query("op13_ranked_search", sql.RANKED)
def op13(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return ranked.ranked_search(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "benchmark", ["item_id", "text"]), k=50)
