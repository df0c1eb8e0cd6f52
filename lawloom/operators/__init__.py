from lawloom.operators.contracts import ContractError, check_contract, conform, contract_violations
from lawloom.operators.layout import (
    annex_start,
    assemble_text,
    attach_clean_text,
    clean_lines,
    clean_text,
    cut_annex,
    explode_lines,
    page_counts,
    repeated_lines,
)
from lawloom.operators.calls import Calls
from lawloom.operators.changes import changed, settings_digest, with_digest
from lawloom.operators.merge import merge_tables, new_rows
from lawloom.operators.model import (
    build_requests,
    entity_rows,
    parse_summaries,
    parse_topics,
    run_model,
    summary_instructions,
    summary_rows,
    topic_instructions,
    topic_rows,
)
from lawloom.operators.normalize import distinct_author_ids, proposition_rows, unique_authors
from lawloom.operators.prepare import (
    count_rejections,
    count_stages,
    count_steps,
    drop_fields,
    group_authors,
    has_id,
    is_valid,
    keep_valid,
    merge_authors,
    rejection_reason,
    watch_rejections,
    watched_counts,
)
from lawloom.operators.words import deal_texts, default_stop_words, drop_stop_words, explode_words, word_frequency

__all__ = [name for name in dir() if not name.startswith("_")]
