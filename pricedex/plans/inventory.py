"""Where each operator of the inventory lives, and which registered queries exercise it."""

from __future__ import annotations

# id -> (implementation, registered queries)
INVENTORY: dict[str, tuple[str, tuple[str, ...]]] = {
    "S01": ("sources.files.read_wide_tsv", ("s01_wide_bulk_clean",)),
    "S02": ("sources.files.read_long_csv, file_headers, decoded", ("s02_long_csv_clean",)),
    "S03": ("sources.files.read_series_csv", ("s03_series_csv_clean",)),
    "S04": ("sources.files.read_sdmx_xml", ("s04_sdmx_xml_clean",)),
    "S05": ("sources.files.read_price_json", ("s05_price_json_clean",)),
    "S06": ("sources.files.extract_product, sources.files.html_tokens", ("s06_page_extract", "s06_page_elements")),
    "S07": ("sources.standins.read_table (pruned scans, tests/test_plans.py)", ("f01_modelling_series",)),
    "S08": ("sources.files.write_table, sources.landing", ("s01_wide_bulk_clean", "s02_long_csv_clean")),
    "S09": ("sources.files.load_table, sources.files.publish, sources.files.published",
            ("s09_load_verified", "s09_verified_publish")),
    "S10": ("sources.files.keep_payload", ("s10_payload_kept",)),
    "S11": ("sources.files.write_metrics / read_metrics", ("s11_metrics_json_roundtrip",)),
    "S12": ("sources.files.write_table(dynamic=True)", ("s12_partition_rebuild",)),
    "P01": ("operators.cleaning.clean_wide_bulk (split key)", ("s01_wide_bulk_clean",)),
    "P02": ("operators.cleaning.clean_wide_bulk (filter before unpivot)", ("s01_wide_bulk_clean",)),
    "P03": ("operators.cleaning.clean_wide_bulk (unpivot)", ("s01_wide_bulk_clean",)),
    "P04": ("functions.columns.flagged_number", ("s01_wide_bulk_clean",)),
    "P05": ("operators.cleaning.present, in every cleaner", ("s01_wide_bulk_clean", "s03_series_csv_clean")),
    "P06": ("functions.columns.period_to_date", ("j01_six_digit_normalise", "s02_long_csv_clean")),
    "P07": ("operators.cleaning.normalise_header", ("s03_series_csv_clean",)),
    "P08": ("functions.columns.zero_pad", ("s03_series_csv_clean",)),
    "P09": ("functions.columns.to_number", ("s02_long_csv_clean", "s05_price_json_clean")),
    "P10": ("operators.cleaning.long_csv_steps", ("s02_long_csv_clean",)),
    "P11": ("operators.cleaning.long_csv_steps", ("s02_long_csv_clean",)),
    "P12": ("operators.cleaning.clean_long_csv", ("s02_long_csv_clean",)),
    "P13": ("operators.cleaning.optional_equals", ("s02_long_csv_clean",)),
    "P14": ("operators.cleaning.optional_equals", ("s02_long_csv_clean",)),
    "P15": ("operators.cleaning.optional_equals", ("s02_long_csv_clean",)),
    "P16": ("operators.cleaning.clean_xml_series", ("s04_sdmx_xml_clean",)),
    "P17": ("functions.columns.short_label", ("s04_sdmx_xml_clean", "j06_series_label_lookup")),
    "P18": ("functions.columns.truncate100", ("s04_sdmx_xml_clean",)),
    "P19": ("functions.columns.category_from_tag", ("s05_price_json_clean", "d03_distinct_price_categories")),
    "P20": ("operators.cleaning.clean_prices", ("s05_price_json_clean", "a15_price_stats")),
    "P21": ("operators.cleaning.clean_prices (url)", ("s05_price_json_clean",)),
    "P22": ("operators.normalise._unified (constant tags)", ("u03_unified",)),
    "P23": ("functions.columns.index_filters", ("a10_monthly_trend_filtered", "a16_filtered_count", "l01_index_page")),
    "P24": ("functions.columns.ilike_contains", ("a12_source_comparison", "a15_price_stats_pattern", "q04_series_by_label")),
    "P25": ("operators.analytics.summary (not ilike)", ("a13_summary",)),
    "P26": ("between / isin / or of ands", ("a04_two_area_pivot", "q02_two_sources_in_year")),
    "P27": ("operators.normalise (rlike level-1 patterns)", ("j03_dotted_normalise", "j04_prefixed_normalise")),
    "P28": ("operators.cleaning.step_report, one report per job", ("p28_cleaning_report", "p28_price_report", "p28_series_report", "p28_xml_report", "p28_wide_report")),
    "P29": ("operators.cleaning.clean_*", ("s01_wide_bulk_clean", "s02_long_csv_clean", "s03_series_csv_clean",
                                           "s04_sdmx_xml_clean", "s05_price_json_clean")),
    "J01": ("operators.normalise.normalise_six_digit", ("j01_six_digit_normalise",)),
    "J02": ("operators.normalise.normalise_labelled", ("j02_labelled_normalise",)),
    "J03": ("operators.normalise.normalise_dotted", ("j03_dotted_normalise",)),
    "J04": ("operators.normalise.normalise_prefixed", ("j04_prefixed_normalise",)),
    "J05": ("operators.normalise.first_wins, anti_join_append", ("j05_first_wins_dedup", "j05_idempotent_append", "u03_unified")),
    "J06": ("operators.normalise.label_series", ("j06_series_label_lookup",)),
    "J07": ("operators.windows.category_vs_overall", ("j07_category_vs_overall",)),
    "J08": ("operators.forecast.metrics (aligned by date)", ("j08_actual_vs_predicted",)),
    "J09": ("operators.forecast.overlay", ("j09_history_forecast_overlay",)),
    "J10": ("operators.impact.inflation_in_euros (budgets exploded, no join)", ("f19_inflation_in_euros",)),
    "J11": ("operators.windows.source_gap", ("j11_source_gap",)),
    **{f"A{i:02d}": (f"operators.analytics", (q,)) for i, q in [
        (1, "a01_yearly_mean"), (2, "a02_peak_year"), (3, "a03_top10_categories"), (4, "a04_two_area_pivot"),
        (5, "a05_volatility"), (6, "a06_months_above_threshold"), (7, "a07_coverage_by_source"),
        (8, "a08_coverage_by_source_base"), (9, "a09_load_audit"), (10, "a10_monthly_trend"),
        (11, "a11_top_n_ranked"), (12, "a12_source_comparison"), (13, "a13_summary"), (14, "a14_source_date_range"),
        (15, "a15_price_stats"), (16, "a16_filtered_count"), (17, "a17_yearly_kpis"), (18, "a18_descriptive_stats"),
        (19, "a19_category_kpis"), (20, "a20_seasonality_matrix"), (23, "a23_series_span"),
        (24, "a24_price_vs_index")]},
    "A21": ("operators.forecast.quality_summary", ("a21_forecast_quality_summary",)),
    "A22": ("operators.forecast.quality_mean", ("a22_forecast_quality_mean",)),
    "W01": ("operators.windows.moving_average", ("w01_moving_average_12",)),
    "W02": ("operators.windows.year_over_year (+ calendar variant)", ("w02_year_over_year", "w02_year_over_year_calendar")),
    "W03": ("operators.windows.month_over_month", ("w03_month_over_month",)),
    "W04": ("operators.analytics.top_categories(with_rank)", ("a11_top_n_ranked",)),
    "W05": ("max_by / min_by aggregates", ("a18_descriptive_stats", "a19_category_kpis")),
    "W06": ("operators.windows.year_over_year (direction)", ("w02_year_over_year",)),
    "L01": ("operators.analytics.index_page, operators.pages.page", ("l01_index_page", "l01_page_500_by_key")),
    "L02": ("operators.analytics.price_page, operators.pages.page", ("l02_price_page", "l02_page_35_by_key")),
    "L03": ("orderBy + limit extracts", ("q03_one_month_codes", "q07_two_year_extract")),
    "L04": ("operators.analytics.latest_row", ("l04_latest_row",)),
    "L05": ("sources.files.write_ordered, sources.files.read_ordered", ("l05_sorted_sink",)),
    "L06": ("operators.analytics.distinct_sources(first=...), sources.files.write_ordered", ("d01_distinct_sources", "l06_categories_in_order")),
    "L07": ("metrics ordered by MAE", ("l07_metrics_by_mae",)),
    "D01": ("operators.analytics.distinct_sources", ("d01_distinct_sources",)),
    "D02": ("operators.analytics.distinct_categories", ("d02_distinct_categories",)),
    "D03": ("operators.analytics.distinct_price_categories", ("d03_distinct_price_categories",)),
    "U01": ("operators.analytics.table_volumes", ("u01_table_volumes",)),
    "U02": ("operators.analytics.price_vs_index", ("a24_price_vs_index",)),
    "U03": ("operators.normalise.unify", ("u03_unified",)),
    "Q02": ("operators.analytics.two_sources_in_year", ("q02_two_sources_in_year",)),
    "Q03": ("operators.analytics.one_month_codes", ("q03_one_month_codes",)),
    "Q04": ("operators.analytics.series_by_label", ("q04_series_by_label",)),
    "Q05": ("operators.analytics.prices_by_category", ("q05_prices_by_category",)),
    "Q06": ("operators.analytics.one_area_code", ("q06_one_area_code",)),
    "Q07": ("operators.analytics.two_year_extract", ("q07_two_year_extract",)),
    "F01": ("operators.forecast.modelling_series", ("f01_modelling_series",)),
    "F02": ("operators.forecast.with_split", ("f02_temporal_split",)),
    "F03": ("operators.additive.fit", ("f07_forecast_all", "f13_decomposition", "j08_actual_vs_predicted")),
    "F04": ("operators.forecast.forecast (production fit on all rows)", ("f07_forecast_all",)),
    "F05": ("operators.forecast.future_frame", ("f05_future_frame",)),
    "F06": ("operators.additive.sampled_band", ("f06_prediction_interval", "f07_forecast_all")),
    "F07": ("operators.forecast.forecast (all series, one job)", ("f07_forecast_all",)),
    "F08": ("operators.forecast.check_horizon", ("f05_future_frame",)),
    "F09": ("operators.forecast.metrics", ("f09_forecast_metrics",)),
    "F10": ("operators.monthly.holt_winters", ("f10_holt_winters_weights", "f10_holt_winters_forecast", "f12_model_benchmark")),
    "F11": ("operators.monthly.arima", ("f11_arima_coefficients", "f11_arima_forecast", "f12_model_benchmark")),
    "F12": ("operators.forecast.benchmark", ("f12_model_benchmark",)),
    "F13": ("operators.additive.parts", ("f13_decomposition",)),
    "F14": ("operators.forecast.resolve_category", ("f14_category_resolution",)),
    "F15": ("functions.columns.slug", ("f15_category_slugs",)),
    "F16": ("operators.forecast.total_change", ("f16_total_predicted_change",)),
    "F17": ("operators.impact.budget_simulation", ("f17_budget_simulation",)),
    "F18": ("operators.impact.budget_simulation (monthly, cumulative)", ("f17_budget_simulation",)),
    "F19": ("operators.impact.inflation_in_euros", ("f19_inflation_in_euros",)),
    "F20": ("operators.forecast.reliability", ("f20_reliability_flags",)),
    "F21": ("operators.forecast.modelled_categories", ("f21_modelled_categories",)),
    "M01": ("functions.columns.endpoint_label", ("m01_endpoint_labels",)),
    "M02": ("functions.columns.error_class", ("m02_error_classes",)),
    "M03": ("streaming.monitor.request_counts", ("m03_request_counts", "m03_stream_request_counts")),
    "M04": ("streaming.monitor.latency_histogram", ("m04_latency_histogram",)),
    "M05": ("streaming.monitor.latency_quantiles, streaming.monitor.sketch_quantiles",
            ("m05_latency_quantiles", "m05_predict_latency_quantiles", "m05_stream_latency_quantiles",
             "m05_sketch_quantiles")),
    "M06": ("streaming.monitor.request_rate", ("m06_request_rate", "m06_request_rate_5m")),
    "M07": ("streaming.monitor.error_ratio", ("m07_error_ratio", "m07_stream_error_ratio")),
    "M08": ("streaming.monitor.errors_by_type, predictions_by_category",
            ("m08_errors_by_type", "m08_predictions_by_category")),
    "M09": ("operators.forecast.reliability (alert)", ("m09_mae_alert",)),
    "M10": ("streaming.monitor.held_for, streaming.monitor.alert_runs",
            ("m10_alert_held_for", "m10_stream_alert_held_for")),
    "M11": ("streaming.monitor.absences, streaming.monitor.activity",
            ("m11_absences", "m11_stream_absences")),
}
