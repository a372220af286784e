"""plazalens: place-and-review analytics as Spark DataFrame functions.

Every public function takes DataFrames (plus plain arguments) and returns a
DataFrame; none of them runs an action unless its name says it writes or
reads, or its docstring says it runs a job (size checks, the opt-in dedup
prefilter).
"""

from plazalens.functions.text import (
    extract_state,
    map_state,
    matches_terms,
    tokenize,
    tokens,
    truncate,
)
from plazalens.operators.clean import (
    dedup_columns,
    dedup_rows,
    drop_blank,
    drop_null,
    epoch_ms_to_date,
    fill_number,
    fill_text,
    text_to_date,
    to_int_rating,
)
from plazalens.operators.dictionary import dictionary_hits, filter_dictionary
from plazalens.operators.gold import gold_google_reviews, gold_places, gold_yelp_reviews, review_key
from plazalens.operators.nested import attributes_list, expand_struct, true_flag_names, true_flags
from plazalens.operators.neighbours import nearest_of_all
from plazalens.operators.quality import (
    contract_violations,
    distinct_count,
    null_counts,
    pk_duplicates,
    profile,
    stage_counts,
)
from plazalens.operators.phrases import merge_phrases
from plazalens.operators.recommend import (
    candidates,
    cosine_to_anchor,
    recommend_nearby,
    recommend_similar,
    requests_frame,
)
from plazalens.operators.sentiment import (
    PUBLISHED_RULES,
    extremes,
    label,
    lexicon_frame,
    lexicon_rejects,
    read_lexicon,
    sentiment_scores,
    sentiment_table,
)
from plazalens.plans.incremental import IncrementalRun, run_incremental, run_stage
from plazalens.plans.medallion import (
    gold_google_places,
    gold_yelp_business,
    silver_google_place_keys,
    silver_google_places,
    silver_google_reviews,
    silver_yelp_business,
    silver_yelp_business_keys,
    silver_yelp_reviews,
)
from plazalens.plans.profiles import layer_profile, merge_profiles, run_profile, unit_profiles
from plazalens.plans.versioned import VersionedRun, run_versioned, run_versioned_stage
from plazalens.session import get_session, scratch_path, scratch_root
from plazalens.sources.io import (
    layer_path,
    list_units,
    read_json,
    read_layer,
    read_parquet,
    select_by_ordinal,
    split_rejects,
    state_dimension,
    write_parquet,
    write_parquet_counted,
)
from plazalens.sources.ledger import append_ledger, new_units, read_ledger
from plazalens.sources.load import LoadError, append_table, drop_unpublished, load_table, read_table
from plazalens.streaming.ingest import ingest_available_now
from plazalens.streaming.layers import stream_layers

__all__ = [name for name in dir() if not name.startswith("_")]
