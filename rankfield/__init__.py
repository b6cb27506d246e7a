"""Retrieval and analytics over parquet tables, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so a cluster runs them
# without having the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from rankfield.functions.distances import (  # noqa: E402
    DISTANCE_FUNCTIONS,
    cosine_distance,
    l2_distance,
    negative_dot_product,
    relevance_score,
)
from rankfield.operators.bm25 import bm25_scan  # noqa: E402
from rankfield.operators.embed import HashingEmbedder, ModelEmbedder, embed, vector_distance  # noqa: E402
from rankfield.operators.envelope import CappedResult, capped_result  # noqa: E402
from rankfield.operators.fusion import RRF_K, fuse, hybrid  # noqa: E402
from rankfield.operators.knn import knn  # noqa: E402
from rankfield.operators.merge import apply_load, get_by_ids  # noqa: E402
from rankfield.operators.mmr import mmr, mmr_select  # noqa: E402
from rankfield.operators.paging import deep_page  # noqa: E402
from rankfield.operators.profile import column_stats, table_overview, table_profile  # noqa: E402
from rankfield.plans.search import (  # noqa: E402
    SearchPlan,
    plan_search,
    search,
    search_capped,
    search_table,
    semantic_search,
)
from rankfield.plans.store import DocumentStore, promote_metadata  # noqa: E402
from rankfield.session import clear_scratch  # noqa: E402
from rankfield.sources.attach import attach, catalogs_in_scope, detach  # noqa: E402
from rankfield.sources.cells import CellIndex  # noqa: E402
from rankfield.sources.copies import create_sorted_copy, read_sorted_copy  # noqa: E402
from rankfield.sources.database import Database, ManagedTable  # noqa: E402
from rankfield.sources.footers import stored_profile  # noqa: E402
from rankfield.sources.indexes import (  # noqa: E402
    create_text_index,
    create_vector_index,
    open_text_index,
    open_vector_index,
    refresh_indexes,
    table_rankings,
)
from rankfield.sources.parquet import scan_parquet  # noqa: E402
from rankfield.sources.postings import PostingsIndex  # noqa: E402
from rankfield.sources.rankings import Rankings, TextIndex, VectorIndex  # noqa: E402

__all__ = [
    "DISTANCE_FUNCTIONS",
    "RRF_K",
    "CappedResult",
    "CellIndex",
    "Database",
    "DocumentStore",
    "HashingEmbedder",
    "ManagedTable",
    "ModelEmbedder",
    "PostingsIndex",
    "Rankings",
    "SearchPlan",
    "TextIndex",
    "VectorIndex",
    "apply_load",
    "attach",
    "bm25_scan",
    "capped_result",
    "catalogs_in_scope",
    "clear_scratch",
    "column_stats",
    "cosine_distance",
    "create_sorted_copy",
    "create_text_index",
    "create_vector_index",
    "deep_page",
    "detach",
    "embed",
    "fuse",
    "get_by_ids",
    "hybrid",
    "knn",
    "l2_distance",
    "mmr",
    "mmr_select",
    "negative_dot_product",
    "open_text_index",
    "open_vector_index",
    "plan_search",
    "promote_metadata",
    "read_sorted_copy",
    "refresh_indexes",
    "relevance_score",
    "scan_parquet",
    "search",
    "search_capped",
    "search_table",
    "semantic_search",
    "stored_profile",
    "table_overview",
    "table_profile",
    "table_rankings",
    "vector_distance",
]
