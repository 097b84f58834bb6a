"""Write COVERAGE.md: every SURVEY §2 operator -> function, registered query, oracle kind."""
from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from marquee.plans.catalog import ORACLES, QUERIES, load_all  # noqa: E402

# (section, survey id, implementing function, registered queries)
MAP = [
    ("A", "read_ratings_csv", "sources.files.read_ratings_csv", ["read_ratings_csv", "read_ratings_reordered", "unparsable_ratings"]),
    ("A", "read_movies_csv", "sources.files.read_movies_csv", ["read_movies_csv", "read_movies_multiline", "read_quoted_documents"]),
    ("A", "read_tags_csv", "sources.files.read_tags_csv", ["read_tags_csv"]),
    ("A", "read_links_csv", "sources.files.read_links_csv", ["read_links_csv", "read_links_csv_no_tmdb", "read_links_no_imdb"]),
    ("A", "read_genome_csv", "sources.files.read_genome_csv", ["read_genome_csv"]),
    ("A", "read_ratings_dat / read_movies_dat", "sources.files.read_ratings_dat / read_movies_dat", ["read_ratings_dat", "read_movies_dat"]),
    ("A", "read_ratings_tab", "sources.files.read_ratings_tab", ["read_ratings_tab"]),
    ("A", "read_movies_pipe", "sources.files.read_movies_pipe", ["read_movies_pipe"]),
    ("A", "discover_inputs", "sources.discover.discover_inputs", ["discover_inputs", "ingest_all"]),
    ("A", "detect_variant", "sources.discover.detect_variant", ["detect_variant"]),
    ("A", "expand_archives", "sources.discover.expand_archives", ["expand_archives"]),
    ("A", "require_columns", "sources.files.require_columns", ["require_columns"]),
    ("A", "load_user_features / load_item_features", "operators.features.load_features", ["load_user_features", "load_item_features"]),
    ("B", "drop_null_keys", "operators.merge.drop_null_keys", ["drop_null_keys"]),
    ("B", "null_sentinel", "operators.merge.null_sentinel", ["null_sentinel"]),
    ("B", "stamp_inserted_at", "operators.merge.stamp_inserted_at", ["stamp_inserted_at"]),
    ("B", "merge_upsert", "operators.merge.merge_upsert / operators.buckets.merge_rows", ["merge_upsert", "upsert_keeps_id", "splits_after_upsert", "bucket_growth"]),
    ("B", "merge_skip", "operators.merge.merge_skip", ["merge_skip"]),
    ("B", "merge_replace", "operators.merge.merge_replace", ["merge_replace"]),
    ("B", "ingest_report", "sources.files.ingest_report", ["ingest_report", "ingest_with_bad_file", "ingest_all"]),
    ("B", "write_features", "operators.merge.merge_upsert (plans.stages.run_featurize)", ["write_features"]),
    ("B", "write_split", "operators.split.write_split", ["write_split"]),
    ("B", "write_model_rows", "operators.buckets.write_model_rows", ["write_model_rows"]),
    ("B", "max_inserted_watermark", "operators.merge.max_inserted_watermark", ["max_inserted_watermark", "watermarks_partial_run"]),
    ("C", "check_row_count", "operators.quality.check_row_count", ["check_row_count"]),
    ("C", "check_null_keys", "operators.quality.check_null_keys", ["check_null_keys"]),
    ("C", "check_null_titles", "operators.quality.check_null_titles", ["check_null_titles"]),
    ("C", "check_rating_range", "operators.quality.check_rating_range", ["check_rating_range"]),
    ("C", "distinct_users, distinct_rated_movies", "operators.quality.distinct_counts / distinct_estimates", ["distinct_counts", "distinct_by_sketches"]),
    ("C", "orphan_ratings", "operators.quality.orphan_ratings", ["orphan_ratings"]),
    ("C", "validate_all", "operators.quality.validate_all", ["validate_all", "validate_failing"]),
    ("C", "table_counts", "operators.quality.table_counts", ["table_counts"]),
    ("D", "with_global_index", "operators.split.with_global_index", ["with_global_index"]),
    ("D", "temporal_split", "operators.split.temporal_split", ["temporal_split"]),
    ("D", "split_counts", "operators.split.split_counts", ["split_counts"]),
    ("D", "load_splits", "operators.split.load_splits", ["load_splits"]),
    ("D", "split_filter", "operators.split.split_filter", ["split_filter"]),
    ("D", "sample_decay_weights", "operators.samples.sample_decay_weights", ["sample_decay_weights"]),
    ("D", "best_demonstration", "operators.samples.best_demonstration", ["best_demonstration"]),
    ("D", "training_samples", "operators.samples.training_samples", ["training_samples"]),
    ("D", "demo_context", "operators.samples.demo_context", ["demo_context"]),
    ("D", "id_space", "operators.samples.id_space", ["id_space"]),
    ("D", "pad_sequences", "operators.samples.pad_sequences", ["pad_sequences"]),
    ("E", "extract_year", "functions.text.extract_year", ["extract_year"]),
    ("E", "time_bounds", "operators.features.time_bounds", ["time_bounds"]),
    ("E", "time_decay_weight", "operators.features.time_decay_weight", ["time_decay_weight"]),
    ("E", "explode_genres", "operators.features.explode_genres", ["explode_genres"]),
    ("E", "decayed_history", "operators.features.decayed_history", ["decayed_history", "features_with_history"]),
    ("E", "genre_affinity", "operators.features.genre_affinity", ["genre_affinity"]),
    ("E", "genre_affinity_vector", "operators.features.genre_affinity_vector", ["genre_affinity_vector"]),
    ("E", "rating_stats", "operators.features.rating_stats", ["rating_stats"]),
    ("E", "user_features", "operators.features.user_features", ["user_features"]),
    ("E", "genre_multihot", "operators.features.genre_multihot", ["genre_multihot"]),
    ("E", "tag_documents", "operators.features.tag_tokens", ["tag_documents"]),
    ("E", "tag_tfidf", "operators.features.tag_tfidf", ["tag_tfidf"]),
    ("E", "item_features", "operators.features.item_features", ["item_features"]),
    ("E", "feature_counts", "operators.features.feature_counts", ["feature_counts"]),
    ("F", "encode_items", "operators.encode.encode_items", ["encode_items"]),
    ("F", "encode_users", "operators.encode.encode_users", ["encode_users"]),
    ("F", "lookup_user_vectors", "equi-join on user_id (plans.q_losses)", ["lookup_user_vectors"]),
    ("F", "fit_factors", "operators.factors.fit_factors", ["fit_factors"]),
    ("F", "sweep_factors", "operators.factors.sweep_factors", ["sweep_factors"]),
    ("F", "best_trial", "operators.factors.best_trial", ["best_trial"]),
    ("F", "pending_combos", "operators.factors.pending_combos", ["pending_combos"]),
    ("F", "ema_blend", "operators.losses.ema_blend", ["ema_blend"]),
    ("G", "l2_normalize", "operators.retrieve.l2_normalize", ["l2_normalize"]),
    ("G", "score_cosine", "functions.vectors.cosine", ["score_cosine"]),
    ("G", "score_dot", "functions.vectors.dot", ["score_dot"]),
    ("G", "score_l2", "functions.vectors.sqdist", ["score_l2"]),
    ("G", "score_learned", "operators.retrieve.score_learned_pairs / learned_scores", ["score_learned", "topk_user_genre_learned"]),
    ("G", "genre_membership", "operators.retrieve.genre_membership", ["genre_membership"]),
    ("G", "topk_global", "operators.retrieve.topk_global", ["topk_global"]),
    ("G", "topk_user_genre", "operators.retrieve.topk_user_genre", ["topk_user_genre", "topk_user_genre_blocked"]),
    ("G", "cold_start_genre", "operators.retrieve.cold_start_genre", ["cold_start_genre"]),
    ("G", "precompute_serving", "operators.retrieve.precompute_serving", ["precompute_serving"]),
    ("G", "save_item_index / load_item_index", "operators.item_index.save_item_index / load_item_index / ItemIndex.search", ["item_index_roundtrip", "item_index_search"]),
    ("G", "precompute_counts", "operators.retrieve.precompute_counts", ["precompute_counts"]),
    ("H", "weighted_mse", "operators.losses.weighted_mse", ["weighted_mse"]),
    ("H", "infonce_loss", "operators.losses.infonce_loss", ["infonce_loss", "infonce_loss_large_batch"]),
    ("H", "embedding_kl", "operators.losses.embedding_kl", ["embedding_kl"]),
    ("H", "cross_kl", "operators.losses.cross_kl", ["cross_kl"]),
    ("H", "model_pairs", "operators.losses.model_pairs", ["model_pairs"]),
    ("H", "batch_mean_loss", "operators.losses.batch_mean_loss", ["batch_mean_loss"]),
    ("H", "embedding_norm_stats", "operators.losses.embedding_norm_stats", ["embedding_norm_stats"]),
    ("H", "best_epoch", "operators.losses.best_epoch", ["best_epoch"]),
    ("I", "lookup_user", "operators.lookup.lookup_user", ["lookup_user"]),
    ("I", "lookup_cold_start", "operators.lookup.lookup_cold_start", ["lookup_cold_start"]),
    ("I", "batch_recommend", "operators.lookup.batch_recommend", ["batch_recommend", "lookup_edge_requests"]),
    ("I", "multi_model_recommend", "operators.lookup.multi_model_recommend", ["multi_model_recommend"]),
    ("I", "top_genres", "operators.lookup.top_genres", ["top_genres"]),
    ("I", "explain", "operators.lookup.explain", ["explain", "explain_cold_start"]),
    ("I", "enrich_recs", "operators.lookup.enrich_recs", ["enrich_recs"]),
    ("I", "ab_assign", "operators.lookup.ab_assign", ["ab_assign"]),
    ("I", "ab_compare", "operators.lookup.ab_compare", ["ab_compare"]),
    ("I", "search_titles", "operators.lookup.search_titles", ["search_titles", "search_titles_index"]),
    ("J", "runs_filtered", "operators.metrics.runs_filtered", ["runs_filtered", "runs_filtered_distill"]),
    ("J", "metric_history", "operators.metrics.metric_history", ["metric_history"]),
    ("J", "latest_metric", "operators.metrics.latest_metric", ["latest_metric"]),
    ("J", "sweep_trials", "operators.metrics.sweep_trials", ["sweep_trials"]),
    ("J", "run_summary", "operators.metrics.run_summary", ["run_summary"]),
    ("K", "new_rows_since", "operators.watermark.new_rows_since", ["new_rows_since", "new_rows_no_watermark", "new_row_counts", "new_rows_by_manifest", "new_row_counts_by_files"]),
    ("K", "first_changed_table", "operators.watermark.first_changed_table", ["first_changed_table", "first_changed_by_files"]),
    ("K", "stream_ingest", "streaming.ingest.stream_ingest", ["stream_ingest"]),
    ("K", "daily_gate", "operators.watermark.daily_gate", ["daily_gate"]),
    ("K", "trigger_log_update", "operators.watermark.trigger_log_update / create_triggers", ["trigger_log_update", "create_triggers"]),
]


def main() -> None:
    load_all()
    used = set()
    lines = ["# COVERAGE — SURVEY §2 operators → code → registered queries", "",
             "Generated by `python tools/coverage.py`. Oracle: **S** = DuckDB SQL compared on row count, schema and",
             "values; **R** = rows-only (the driver's weaker check) plus unit tests.", "",
             "| § | Survey operator | Implemented by (`marquee.`…) | Registered queries (oracle) |", "|---|---|---|---|"]
    for sec, sid, fn, qs in MAP:
        for q in qs:
            if q not in QUERIES:
                raise SystemExit(f"{q} is not registered")
            used.add(q)
        cells = ", ".join(f"`{q}` ({'S' if q in ORACLES else 'R'})" for q in qs)
        lines.append(f"| {sec} | {sid} | `{fn}` | {cells} |")
    extra = sorted(set(QUERIES) - used)
    lines += ["", f"Registered queries: {len(QUERIES)}; with a SQL oracle: {len(ORACLES)}."]
    if extra:
        lines.append("Not mapped above: " + ", ".join(f"`{q}`" for q in extra))
    lines += ["", "§2.M (nothing to build in the reference) is covered by the scorer registry "
              "`functions.vectors.SCORERS` / `register_scorer`.", ""]
    open(__file__.rsplit("/tools/", 1)[0] + "/COVERAGE.md", "w").write("\n".join(lines))
    print("\n".join(lines[-5:]))


if __name__ == "__main__":
    main()
