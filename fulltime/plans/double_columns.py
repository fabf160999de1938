"""Generated by tools/oracle_check.py --refresh-doubles: double-typed output columns per query key."""

DOUBLE_COLUMNS: dict[str, list[str]] = {
    'alias_lookup': ['elo_rating'],
    'array_fns': ['mean_x', 'mean_y'],
    'avg_visible': ['avg_visible'],
    'club_stats': ['goals', 'shots', 'xg', 'minutes', 'total_cmp', 'total_att'],
    'compass': ['wind_direction_deg'],
    'concat_sources': ['xg_for', 'xg_against'],
    'corr_features': ['corr'],
    'corr_rating_result': ['corr'],
    'elo_asof': ['elo_rating'],
    'elo_expected': ['expected_home'],
    'elo_latest': ['elo_rating'],
    'elo_ratings': ['elo_home_before', 'elo_away_before', 'elo_home_after', 'elo_away_after', 'elo_diff', 'we_home', 'we_away'],
    'elo_snapshot': ['elo_rating'],
    'elo_wdl': ['p_home_win', 'p_draw', 'p_away_win'],
    'encode_cat': ['shot_body_part_enc', 'shot_type_enc', 'pitch_zone_enc'],
    'export_table': ['xg_for', 'xga_against', 'avg_possession', 'avg_ppda', 'avg_shots', 'xg_diff', 'xg_points', 'luck_index'],
    'feature_importances': ['importance'],
    'frames_of': ['loc_x', 'loc_y'],
    'goals_by_edition': ['xg'],
    'implied_probs': ['ip_home', 'ip_draw', 'ip_away', 'margin'],
    'impute_features': ['distance_to_goal', 'angle_to_goal', 'distance_nearest_defender', 'gk_distance_to_goalline'],
    'ingest_events': ['loc_x', 'loc_y', 'shot_xg', 'duration', 'pass_end_x', 'pass_end_y', 'carry_end_x', 'carry_end_y', 'pass_length'],
    'ingest_frames': ['loc_x', 'loc_y'],
    'last_n_shots': ['shot_xg'],
    'layer_roundtrip': ['xg', 'xg_per_shot', 'avg_shot_distance', 'xga', 'possession_pct', 'ppda', 'avg_pass_length', 'avg_defensive_line_x'],
    'market_features': ['squad_value_m', 'squad_value_log', 'avg_player_value_m', 'top3_value_m', 'depth_value_ratio'],
    'match_features': ['elo_home', 'elo_away', 'elo_diff', 'elo_home_win_prob', 'home_xg_per_game', 'home_xga_per_game', 'home_ppda', 'home_possession_pct', 'home_prog_passes', 'home_def_line_x', 'home_dominance_score', 'away_xg_per_game', 'away_xga_per_game', 'away_ppda', 'away_possession_pct', 'away_prog_passes', 'away_def_line_x', 'away_dominance_score', 'xg_diff', 'ppda_diff', 'possession_diff', 'dominance_diff', 'home_form_xg', 'away_form_xg', 'home_form_xga', 'away_form_xga', 'home_form_ppda', 'away_form_ppda', 'home_form_possession', 'away_form_possession', 'form_xg_diff'],
    'match_features_v2': ['elo_home', 'elo_away', 'elo_diff', 'elo_home_win_prob', 'home_xg_per_game', 'home_xga_per_game', 'home_ppda', 'home_possession_pct', 'home_prog_passes', 'home_def_line_x', 'home_dominance_score', 'away_xg_per_game', 'away_xga_per_game', 'away_ppda', 'away_possession_pct', 'away_prog_passes', 'away_def_line_x', 'away_dominance_score', 'xg_diff', 'ppda_diff', 'possession_diff', 'dominance_diff', 'home_form_xg', 'away_form_xg', 'home_form_xga', 'away_form_xga', 'home_form_ppda', 'away_form_ppda', 'home_form_possession', 'away_form_possession', 'form_xg_diff', 'home_squad_avg_overall', 'home_squad_top11_overall', 'home_squad_avg_potential', 'home_squad_depth_score', 'home_squad_overall_std', 'home_def_avg_overall', 'home_mid_avg_overall', 'home_att_avg_overall', 'home_squad_avg_age', 'home_squad_top11_avg_age', 'home_squad_peak_pct', 'home_squad_veteran_pct', 'home_squad_young_pct', 'home_form_ppg', 'home_form_xg_per_game', 'home_form_xga_per_game', 'home_form_xg_diff', 'home_form_win_rate', 'home_form_clean_sheet_pct', 'home_squad_value_m', 'home_squad_value_log', 'home_avg_player_value_m', 'home_top3_value_m', 'home_depth_value_ratio', 'away_squad_avg_overall', 'away_squad_top11_overall', 'away_squad_avg_potential', 'away_squad_depth_score', 'away_squad_overall_std', 'away_def_avg_overall', 'away_mid_avg_overall', 'away_att_avg_overall', 'away_squad_avg_age', 'away_squad_top11_avg_age', 'away_squad_peak_pct', 'away_squad_veteran_pct', 'away_squad_young_pct', 'away_form_ppg', 'away_form_xg_per_game', 'away_form_xga_per_game', 'away_form_xg_diff', 'away_form_win_rate', 'away_form_clean_sheet_pct', 'away_squad_value_m', 'away_squad_value_log', 'away_avg_player_value_m', 'away_top3_value_m', 'away_depth_value_ratio', 'overall_diff', 'top11_overall_diff', 'def_overall_diff', 'age_diff', 'peak_pct_diff', 'veteran_pct_diff', 'recent_form_ppg_diff', 'recent_xg_diff_diff', 'squad_value_diff', 'depth_score_diff', 'home_squad_risk_score', 'away_squad_risk_score', 'squad_risk_diff'],
    'match_timeline': ['loc_x', 'loc_y', 'end_x', 'end_y', 'shot_xg', 'duration', 'pass_end_x', 'pass_end_y', 'carry_end_x', 'carry_end_y', 'pass_length', 'distance_to_goal', 'angle_to_goal'],
    'math_fns': ['log_value', 'third_value'],
    'measures_scorers': ['total_xg', 'goals_above_xg', 'conversion_pct'],
    'measures_style': ['mean_ppda', 'mean_xg_diff', 'best_xg_diff'],
    'measures_xg': ['mean_xg', 'agreement', 'goal_rate'],
    'name_join': ['club_goals', 'club_xg'],
    'opening_odds': ['odd_home', 'odd_draw', 'odd_away'],
    'over_under': ['p_over', 'odd_over', 'odd_under'],
    'pitch_geometry': ['distance_to_goal', 'angle_to_goal'],
    'player_match_stats': ['xg_total', 'xg_per_shot', 'avg_shot_distance', 'avg_shot_angle', 'xa_total', 'avg_pass_length', 'pass_completion_pct', 'pressure_high_pct', 'carry_distance_total', 'duel_win_pct'],
    'read_csv_table': ['xg_for'],
    'recent_form': ['form_ppg', 'form_xg_per_game', 'form_xga_per_game', 'form_xg_diff', 'form_goals_per_game', 'form_goals_ag_per_game', 'form_clean_sheet_pct', 'form_win_rate', 'form_ppg_rounded'],
    'report_over': ['xg_expected', 'goals_above_xg'],
    'report_pressing': ['avg_ppda', 'avg_possession'],
    'report_scorers': ['xg', 'goals_minus_xg'],
    'report_technique': ['xg_mean', 'xg_total', 'avg_distance', 'conversion_pct'],
    'report_xg_diff': ['xg_for', 'xg_against', 'xg_diff'],
    'report_xg_type': ['our_xg_mean', 'provider_xg_mean', 'goal_rate'],
    'report_zone': ['xg_mean', 'xg_total', 'conversion_pct'],
    'results_by_year': ['goals_per_match'],
    'safe_pct': ['conversion_pct', 'prog_carry_pct'],
    'shot_defenders': ['def_x', 'def_y', 'def_dist'],
    'shot_frame_measures': ['distance_nearest_defender', 'gk_distance_to_shooter', 'gk_distance_to_goalline'],
    'shot_map': ['loc_x', 'loc_y', 'shot_xg', 'distance_to_goal', 'angle_to_goal', 'distance_nearest_defender', 'gk_distance_to_shooter', 'gk_distance_to_goalline'],
    'shot_models': ['auc', 'brier', 'log_loss'],
    'shots_only': ['shot_xg', 'distance_to_goal', 'angle_to_goal'],
    'squad_by_position': ['gk_avg_overall', 'def_avg_overall', 'mid_avg_overall', 'att_avg_overall'],
    'squad_depth': ['squad_top11_overall', 'squad_top11_avg_age', 'squad_bench_overall', 'squad_depth_score'],
    'squad_features': ['squad_avg_overall', 'squad_overall_std', 'squad_avg_potential', 'squad_avg_age', 'gk_avg_overall', 'def_avg_overall', 'mid_avg_overall', 'att_avg_overall', 'squad_top11_overall', 'squad_top11_avg_age', 'squad_bench_overall', 'squad_peak_pct', 'squad_veteran_pct', 'squad_young_pct', 'squad_depth_score', 'form_ppg', 'form_xg_per_game', 'form_xga_per_game', 'form_xg_diff', 'form_goals_per_game', 'form_goals_ag_per_game', 'form_clean_sheet_pct', 'form_win_rate', 'form_ppg_rounded', 'squad_value_m', 'squad_value_log', 'avg_player_value_m', 'top3_value_m', 'depth_value_ratio'],
    'squad_median_fill': ['squad_avg_overall', 'form_ppg', 'squad_value_m', 'depth_value_ratio'],
    'squad_ratings': ['squad_avg_overall', 'squad_overall_std', 'squad_avg_potential', 'squad_avg_age', 'gk_avg_overall', 'def_avg_overall', 'mid_avg_overall', 'att_avg_overall', 'squad_top11_overall', 'squad_top11_avg_age', 'squad_bench_overall', 'squad_peak_pct', 'squad_veteran_pct', 'squad_young_pct', 'squad_depth_score'],
    'squad_risk': ['avg_age', 'peak_pct', 'veteran_pct', 'avg_overall', 'form_ppg', 'risk_score'],
    'standings': ['xg_for', 'xga_against', 'avg_possession', 'avg_ppda', 'avg_shots', 'xg_diff', 'xg_points', 'luck_index'],
    'stream_odds': ['last_odd_home', 'last_odd_draw', 'last_odd_away', 'mean_odd_home'],
    'stream_parse': ['odd_home', 'odd_draw', 'odd_away'],
    'stream_upsert': ['odd_home', 'odd_draw', 'odd_away'],
    'stream_weather': ['mean_wind_kmh', 'max_wind_kmh'],
    'summary_stats': ['mean', 'stddev', 'min', 'p25', 'p50', 'p75', 'max'],
    'team_performance': ['xg', 'xg_per_shot', 'avg_shot_distance', 'xga', 'possession_pct', 'ppda', 'avg_pass_length', 'avg_defensive_line_x'],
    'team_style': ['xg_per_game', 'xg_total', 'shots_per_game', 'shots_on_target_per_game', 'goals_per_game', 'avg_shot_distance', 'xga_per_game', 'xga_total', 'goals_conceded_per_game', 'clearances_per_game', 'avg_defensive_line_x', 'avg_possession_pct', 'progressive_passes_per_game', 'progressive_carries_per_game', 'avg_pass_length', 'crosses_per_game', 'avg_ppda', 'xg_diff_total', 'xg_diff_per_game', 'win_pct', 'dominance_score'],
    'team_style_overall': ['overall_xg_per_game', 'overall_xga_per_game', 'overall_ppda', 'overall_possession_pct', 'overall_prog_passes', 'overall_defensive_line_x', 'overall_xg_diff', 'overall_dominance_score'],
    'top1_value': ['best_xg_diff_per_game'],
    'top_scorers': ['xg_total', 'goals_minus_xg', 'xa_total', 'goals_per_90', 'xg_per_90', 'shot_conversion_pct', 'shots_on_target_pct'],
    'top_scorers_cross': ['xg_total', 'goals_per_match', 'xg_per_match'],
    'topk_shots': ['shot_xg', 'distance_to_goal'],
    'trailing_form': ['form_xg', 'form_xga', 'form_ppda', 'form_possession', 'form_goals', 'form_goals_ag'],
    'upsert_timeline': ['loc_x', 'loc_y', 'end_x', 'end_y', 'shot_xg', 'duration', 'pass_end_x', 'pass_end_y', 'carry_end_x', 'carry_end_y', 'pass_length', 'distance_to_goal', 'angle_to_goal'],
    'v_scorers': ['xg_total', 'goals_above_xg', 'shot_conversion_pct', 'goals_per_90'],
    'v_shots': ['distance_to_goal', 'angle_to_goal', 'our_xg', 'provider_xg'],
    'v_styles': ['avg_possession_pct', 'avg_ppda', 'xg_per_game', 'xga_per_game', 'xg_diff_per_game', 'dominance_score', 'win_pct'],
    'xg_agreement': ['mae', 'corr'],
    'xg_predictions': ['distance_to_goal', 'angle_to_goal', 'shot_xg', 'our_xg'],
    'xg_provider_metrics': ['auc', 'brier', 'log_loss'],
    'xg_summary': ['xg_total', 'xg_mean', 'xg_max'],
    'stream_odds_sliding': ['last_odd_home', 'last_odd_draw', 'last_odd_away', 'mean_odd_home'],
    'stream_parse_weather': ['speed_kmh', 'direction_deg'],
    'fixture_features': ['elo_diff', 'elo_home_win_prob', 'elo_home', 'elo_away', 'xg_diff', 'ppda_diff', 'possession_diff', 'dominance_diff',
                         'home_xg_per_game', 'home_xga_per_game', 'home_ppda', 'home_possession_pct', 'home_prog_passes', 'home_dominance_score',
                         'away_xg_per_game', 'away_xga_per_game', 'away_ppda', 'away_possession_pct', 'away_prog_passes', 'away_dominance_score',
                         'home_form_xg', 'home_form_xga', 'home_form_ppda', 'home_form_wins', 'away_form_xg', 'away_form_xga', 'away_form_ppda',
                         'away_form_wins', 'form_xg_diff', 'form_wins_diff'],
    'two_level_headers': ['Match', 'Performance_GF', 'Performance_GA', 'Expected_xG', 'Expected_xGA'],
    'seed_rankings': ['points'],
}
