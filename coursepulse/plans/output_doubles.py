"""Double-typed output columns of each registered query (generated by tests/oracle.py --doubles)."""

OUTPUT_DOUBLES: dict[str, list[str]] = {
    'a6_feature_table_sink': ['responce', 'regularity_indicator_pwd'],
    'd15_merge_inner': ['responce'],
    'd15_merge_outer': ['responce'],
    'e17_pre_test_aggregate': ['date_assessment', 'final_result'],
    'e18_joint_distribution': ['p'],
    'e19_marginal_by_activity': ['p'],
    'e19_marginal_by_date': ['p'],
    'e1_clicks_by_activity_mean': ['sum_click'],
    'e1_clicks_by_date_activity_std': ['sum_click'],
    'e1_clicks_by_site_median': ['sum_click'],
    'e1_clicks_by_date_prod': ['sum_click'],
    'e1_clicks_sem': ['sum_click'],
    'e1_clicks_skew': ['sum_click'],
    'e1_clicks_count_var': ['v'],
    'e20_flatten_joint': ['p'],
    'e21_entropies': ['entropy_joint', 'entropy_date', 'entropy_acty', 'result'],
    'e22_entropy_deciles': ['q', 'value'],
    'e22_low_date_entropy': ['entropy_joint', 'entropy_date', 'entropy_acty', 'result'],
    'e22_top_date_entropy': ['entropy_joint', 'entropy_date', 'entropy_acty', 'result'],
    'e23_outcome_shares': ['share'],
    'e23_term_shares': ['share'],
    'e25_adjusted_outcome_shares': ['share'],
    'e27_first_days_percent': ['pct'],
    'e22_student_click_quartiles': ['q', 'value'],
    'e28_bootstrap_bands': ['mean', 'low', 'high'],
    'e28_mean_daily_curve': ['mean', 'std', 'sem'],
    'e29_activity_date_profile': ['share'],
    'e30_entropy_density': ['x', 'y', 'density'],
    'e30_unregistration_density': ['x', 'density'],
    'e30_consistency_quartiles': ['q', 'value'],
    'e8_activity_shares': ['share'],
    'e9_day_shares': ['share'],
    'f10_procrastination': ['proc1', 'proc2', 'proc3'],
    'f10_procrastination_range': ['proc1', 'proc2', 'proc3'],
    'f10_procrastination_third_test': ['proc1', 'proc2', 'proc3'],
    'f11_outcome_metrics': ['pwd', 'ws1', 'ws2', 'ws3', 'fwd', 'concentration', 'consistency', 'proc1', 'proc2', 'proc3'],
    'f10_procrastination_own_measures': ['quadratic', 'late_share'],
    'f1_time_regularity': ['regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_ws2', 'regularity_indicator_ws3', 'regularity_indicator_fwd'],
    'f1_time_regularity_shifted': ['regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_ws2', 'regularity_indicator_ws3', 'regularity_indicator_fwd'],
    'f7_activity_regularity': ['concentration', 'consistency'],
    'f7_activity_regularity_range': ['concentration', 'consistency'],
    'g10_outcome_maps': ['fail_vs_pass'],
    'g11_band_average': ['imd_band', 'age_band'],
    'g13_demographics': ['responce', 'imd_band', 'age_band'],
    'g15_fill_zero': ['regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_ws2', 'regularity_indicator_ws3', 'regularity_indicator_fwd'],
    'g15_impute_mean': ['regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_fwd'],
    'g1_numeric_batch': ['value'],
    'g9_response': ['responce'],
    'g9_response_keep_other': ['result_group'],
    'h3_merge_response_effort': ['responce'],
    'h4_response_column': ['responce'],
    'h5_build_features': ['responce', 'num_of_prev_attempts', 'studied_credits', 'date_registration', 'regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_ws2', 'regularity_indicator_ws3', 'regularity_indicator_fwd'],
    'h5_build_features_test': ['responce', 'num_of_prev_attempts', 'studied_credits', 'date_registration', 'regularity_indicator_pwd', 'regularity_indicator_ws1', 'regularity_indicator_ws2', 'regularity_indicator_ws3', 'regularity_indicator_fwd'],
    'h6_temporal_segment': ['responce', 't1_peak', 't1_entropy', 't2_peak', 't2_entropy'],
    'h6_temporal_segment_0': ['responce', 't0_peak', 't0_entropy'],
    'h8_engagement': ['forumng', 'homepage', 'oucontent', 'quiz', 'resource', 'url', 'day_1', 'day_2', 'day_3', 'day_4', 'day_5', 'day_6', 'day_7', 'peak', 'variation', 'kurtosis', 'entropy'],
    'h8_engagement_30day': ['forumng', 'homepage', 'oucontent', 'quiz', 'resource', 'url', 'day_1', 'day_2', 'day_3', 'day_4', 'day_5', 'day_6', 'day_7', 'day_8', 'day_9', 'day_10', 'day_11', 'day_12', 'day_13', 'day_14', 'day_15', 'day_16', 'day_17', 'day_18', 'day_19', 'day_20', 'day_21', 'day_22', 'day_23', 'day_24', 'day_25', 'day_26', 'day_27', 'day_28', 'day_29', 'day_30', 'peak', 'variation', 'kurtosis', 'entropy'],
    'h9_merge_and_process': ['responce', 'peak', 'entropy'],
    'm6_balanced_weights': ['responce', 'weight', 'total_weight'],
    'm8_m10_forest_properties': ['importance'],
    'm11_classification_metrics': ['precision', 'recall', 'f1', 'auc'],
    'm11_scored_table': ['label', 'score', 'prediction'],
    'm12_roc_points': ['threshold', 'fpr', 'tpr'],
    'm13_confusion_matrix': ['label', 'prediction'],
    'm14_best_threshold': ['threshold', 'f1'],
    'm14_threshold_f1': ['threshold', 'f1'],
    'm1_anova_f': ['f_stat'],
    'm1_anova_pvalue': ['f_stat', 'p_value'],
    'm2_pairwise_corr': ['r'],
}
