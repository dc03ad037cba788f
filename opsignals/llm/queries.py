"""The operators' queries and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsignals.llm import exact_dups, licences, turn_trie
from opsignals.llm.bpe import op4_bpe_codec
from opsignals.llm.inner_product import op8_inner_products
from opsignals.llm.near_dups import op6_near_duplicates
from opsignals.llm.neighbours import op1_learned_partitions
from opsignals.llm.packing import op5_packing
from opsignals.llm.periodic_runs import op11_periodic_runs
from opsignals.llm.quality import op10_quality
from opsignals.llm.suffix_dedup import op2_suffix_dedup
from opsignals.llm.token_counts import op7_token_counts
from opsignals.llm.token_files import op3_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_learned_partitions,
        op2_suffix_dedup,
        op3_token_files,
        op4_bpe_codec,
        op5_packing,
        op6_near_duplicates,
        op7_token_counts,
        op8_inner_products,
        licences.op9_licence_scan,
        op10_quality,
        op11_periodic_runs,
        exact_dups.op12_exact_duplicates,
        turn_trie.op13_turn_trie,
    )
}
ORACLES: dict[str, str] = {
    "op9_licence_scan": licences.ORACLE,
    "op12_exact_duplicates": exact_dups.ORACLE,
    "op13_turn_trie": turn_trie.ORACLE,
}
