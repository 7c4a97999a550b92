"""The corpus queries: name -> (query, SQL with the same result or None)."""

from tapeworks.llm import exact_dedup, mixing, ngram_join, packing, pii, prefix_trie, quality_rules, retrieval_packing, secret_links, spelling, substring_dedup, token_codes, url_cascade
from tapeworks.llm.common import documents, prepare


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(documents(spark, sf_dir))


def op3_url_filter(spark, sf_dir):
    prepare(spark)
    return url_cascade.judge(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_mix_sources(spark, sf_dir):
    return mixing.mix(spark, documents(spark, sf_dir))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(spark, packing.pieces(documents(spark, sf_dir)))


def op8_token_codes(spark, sf_dir):
    return token_codes.round_trip(spark, documents(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(spark, documents(spark, sf_dir))


def op2_personal_data(spark, sf_dir):
    return pii.report(spark, documents(spark, sf_dir))


def op4_secret_links(spark, sf_dir):
    return secret_links.report(spark, documents(spark, sf_dir))


def op9_ngram_join(spark, sf_dir):
    return ngram_join.join(spark, documents(spark, sf_dir))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.report(spark, documents(spark, sf_dir))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(spark, documents(spark, sf_dir), deleted=spelling.DELETED)


def op12_prefix_trie(spark, sf_dir):
    prepare(spark)
    return prefix_trie.trie(spark, *prefix_trie.rebuilt(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_retrieval_packing(spark, sf_dir):
    return retrieval_packing.pack(spark, documents(spark, sf_dir))


QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, exact_dedup.OP1_SQL),
    "op3_url_filter": (op3_url_filter, url_cascade.OP3_SQL),
    "op7_mix_sources": (op7_mix_sources, mixing.OP7_SQL),
    "op6_best_fit_packing": (op6_best_fit_packing, None),
    "op8_token_codes": (op8_token_codes, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op2_personal_data": (op2_personal_data, None),
    "op4_secret_links": (op4_secret_links, None),
    "op9_ngram_join": (op9_ngram_join, ngram_join.OP9_SQL),
    "op5_substring_dedup": (op5_substring_dedup, substring_dedup.OP5_SQL),
    "op11_spelling_variants": (op11_spelling_variants, spelling.OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, prefix_trie.OP12_SQL),
    "op13_retrieval_packing": (op13_retrieval_packing, None),
}
