"""The 31 declared tables: columns, keys, relations and write layout.

A column that is not null is the primary key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared columns of every table, in declared order, as Spark DDL.
_DECLARED = {
    "accounting_document_type": """
        accounting_document_type_id long not null, accounting_document_type_cd string,
        accounting_document_type_nm string, active_ind string, language_cd string,
        accounting_document_type_cd_nm string""",
    "atscale_geo_security": """
        region string not null, role string""",
    "calendar_fiscal_period_v": """
        fiscal_year_period_nbr integer not null, month_long_nm string, month_short_nm string,
        month_nbr integer, year_mth integer, month_relevance_dt date, month_start_dt date,
        month_end_dt date, month_sort_sequence_nbr integer, fiscal_period_nbr integer,
        fiscal_period_cd string, fiscal_period_sort_sequence_nbr integer,
        fiscal_year_period_cd string, fiscal_year_period_nm string, season_period_cd string,
        season_alternate_period_cd string, season_nm string, season_relevance_dt date,
        season_start_dt date, season_end_dt date, season_sort_sequence_nbr integer,
        quarter_calendar_nbr integer, quarter_calendar_sequence_nbr integer,
        quarter_business_nbr integer, fiscal_quarter_nbr integer, fiscal_quarter_cd string,
        fiscal_quarter_sort_sequence_nbr integer, fiscal_year_quarter_nbr integer,
        fiscal_year_quarter_cd string, fiscal_year_quarter_alternate_cd string, year_cd string,
        year_nm string, year_nbr string, year_start_dt date, year_end_dt date,
        business_year_nbr integer, fiscal_year_nbr integer, fiscal_year_cd string,
        fiscal_period_sort integer""",
    "CIS_fact": """
        gl_account_id long not null, profit_center_nbr string, fiscal_year_period_nbr integer,
        fiscal_yr integer, transaction_currency_amt decimal(18,5), functional_area_cd string,
        profit_center_id long, division_nbr string, segment_nbr integer,
        partner_segment_nbr integer, document_type_cd string, original_company_cd integer,
        sign_adjusted_group_currency_amt decimal(18,5),
        sign_adjusted_local_currency_amt decimal(18,5),
        sign_adjusted_transaction_currency_amt decimal(18,5), group_currency_amt decimal(18,5),
        local_currency_amt decimal(18,5), qty decimal(18,5),
        consolidated_income_statement_fact_id long, financial_statement_item_cd string,
        local_currency_cd string, transaction_currency_cd string, version_nbr string,
        partner_profit_center_nbr string, partner_unit_cd string, consolidation_unit_cd integer,
        ledger_cd string, dimension_cd string, record_type_cd string,
        consolidation_group_cd string, consolidation_of_investment_activity_nbr integer,
        chart_of_accounts_cd string, trading_partner_nbr integer,
        region_summary_product_group_cd string, version_group_nm string,
        consolidated_segment_nm string, sign_adjusted_qty decimal(18,5), user_nm string,
        additional_operation_information_nm string, created_by_user_id string,
        updated_by_user_id string, physical_source_cd string, cis_store_cd string,
        posting_level_cd string, base_unit_of_measure_cd string, foreign_exchange_type_cd string,
        consolidated_channel_nm string""",
    "company_code": """
        company_id long not null, company_cd string, company_nm string, currency_cd string,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string""",
    "consolidated_balance_sheet_fact": """
        consolidated_balance_sheet_fact_id long not null, financial_statement_item_cd string,
        profit_center_nbr string, functional_area_cd string, local_currency_cd string,
        transaction_currency_cd string, version_nbr string, division_nbr string,
        fiscal_year_period_nbr integer, partner_unit_cd string, posting_level_cd string,
        document_type_cd string, consolidation_unit_cd integer, partner_profit_center_nbr string,
        trading_partner_nbr integer, region_summary_product_group_cd string,
        transaction_currency_amt decimal(18,5), local_currency_amt decimal(18,5),
        group_currency_amt decimal(18,5), partner_segment_nbr integer, segment_nbr string,
        qty decimal(18,5), consolidated_segment_nm string, consolidated_channel_nm string,
        fiscal_yr integer, version_group_nm string, user_nm string,
        additional_operation_information_nm string, created_by_user_id string,
        updated_by_user_id string, physical_source_cd string, _acdocu_latest_load_timestamp date,
        group_currency_cd string, ending_balance_amt decimal(18,5),
        foreign_exchange_type_cd string""",
    "consolidation_functional_area_hierarchy": """
        consolidation_functional_area_hierarchy_id long not null, active_ind string,
        functional_area_cd string, consolidation_functional_area_hierarchy_parent_cd string,
        functional_area_level_nbr integer, functional_area_type_nm string,
        consolidation_functional_area_hierarchy_cd string,
        consolidation_functional_area_hierarchy_desc string,
        consolidation_functional_area_1_cd string, consolidation_functional_area_1_nm string,
        consolidation_functional_area_2_cd string, consolidation_functional_area_2_nm string,
        consolidation_functional_area_3_cd string, consolidation_functional_area_3_nm string,
        consolidation_functional_area_4_cd string, consolidation_functional_area_4_nm string,
        consolidation_functional_area_5_cd string, consolidation_functional_area_5_nm string,
        consolidation_functional_area_6_cd string, consolidation_functional_area_6_nm string,
        consolidation_functional_area_7_cd string, consolidation_functional_area_7_nm string,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string,
        record_created_tmst_utc date, record_update_tmst_utc date,
        _consolidation_functional_area_hierarchy_raw_latest_load_tmst date""",
    "consolidation_segment_hierarchy_dim": """
        consolidation_segment_hierarchy_id long not null, segment_nbr integer,
        segment_desc string, consolidation_segment_hierarchy_parent_cd string,
        segment_type_nm string, segment_level_nbr integer,
        consolidation_segment_hierarchy_cd string, consolidation_segment_hierarchy_desc string,
        consolidation_segment_hierarchy_cd_desc string, consolidation_segment_1_cd string,
        consolidation_segment_1_nm string, consolidation_segment_1_cd_nm string,
        consolidation_segment_2_cd string, consolidation_segment_2_nm string,
        consolidation_segment_2_cd_nm string, consolidation_segment_3_cd string,
        consolidation_segment_3_nm string, consolidation_segment_3_cd_nm string,
        consolidation_segment_4_cd string, consolidation_segment_4_nm string,
        consolidation_segment_4_cd_nm string, consolidation_segment_5_cd string,
        consolidation_segment_5_nm string, consolidation_segment_5_cd_nm string,
        consolidation_segment_6_cd string, consolidation_segment_6_nm string,
        consolidation_segment_6_cd_nm string, consolidation_segment_7_cd string,
        consolidation_segment_7_nm string, consolidation_segment_7_cd_nm string,
        consolidation_segment_8_cd string, consolidation_segment_8_nm string,
        consolidation_segment_8_cd_nm string, consolidation_segment_9_cd string,
        consolidation_segment_9_nm string, consolidation_segment_9_cd_nm string,
        consolidation_segment_10_cd string, consolidation_segment_10_nm string,
        consolidation_segment_10_cd_nm string, created_by_user_id string,
        updated_by_user_id string, physical_source_cd string, active_ind string""",
    "segment_cost_center_hierarchy_dim_v": """
        cost_center_hierarchy_hist_id long not null, cost_center_nbr string,
        cost_center_hierarchy_nm string, cost_center_level_1_cd string,
        cost_center_level_1_nm string, cost_center_level_2_cd string,
        cost_center_level_2_nm string, cost_center_level_3_cd string,
        cost_center_level_3_nm string, cost_center_level_4_cd string,
        cost_center_level_4_nm string, cost_center_level_5_cd string,
        cost_center_level_5_nm string, cost_center_level_6_cd string,
        cost_center_level_6_nm string, cost_center_level_7_cd string,
        cost_center_level_7_nm string, cost_center_level_8_cd string,
        cost_center_level_8_nm string, cost_center_level_9_cd string,
        cost_center_level_9_nm string, cost_center_level_10_cd string,
        cost_center_level_10_nm string, cost_center_level_11_cd string,
        cost_center_level_11_nm string, cost_center_level_12_cd string,
        cost_center_level_12_nm string, cost_center_level_13_cd string,
        cost_center_level_13_nm string, cost_center_level_14_cd string,
        cost_center_level_14_nm string, cost_center_level_15_cd string,
        cost_center_level_15_nm string, cost_center_level_16_cd string,
        cost_center_level_16_nm string, cost_center_level_17_cd string,
        cost_center_level_17_nm string, cost_center_level_18_cd string,
        cost_center_level_18_nm string, cost_center_level_19_cd string,
        cost_center_level_19_nm string, cost_center_level_20_cd string,
        cost_center_level_20_nm string, cost_center_level_21_cd string,
        cost_center_level_21_nm string, cost_center_level_22_cd string,
        cost_center_level_22_nm string, cost_center_level_23_cd string,
        cost_center_level_23_nm string, cost_center_level_24_cd string,
        cost_center_level_24_nm string, cost_center_level_25_cd string,
        cost_center_level_25_nm string, cost_center_level_26_cd string,
        cost_center_level_26_nm string, cost_center_level_27_cd string,
        cost_center_level_27_nm string, cost_center_level_28_cd string,
        cost_center_level_28_nm string, cost_center_level_29_cd string,
        cost_center_level_29_nm string, cost_center_level_30_cd string,
        cost_center_level_30_nm string, controlling_area_cd string""",
    "segment_profit_center_hierarchy": """
        segment_profit_center_nbr string not null, profit_center_hierarchy_nm string,
        profit_center_level_1_cd string, profit_center_level_1_nm string,
        profit_center_level_2_cd string, profit_center_level_2_nm string,
        profit_center_level_3_cd string, profit_center_level_3_nm string,
        profit_center_level_4_cd string, profit_center_level_4_nm string,
        profit_center_level_5_cd string, profit_center_level_5_nm string,
        profit_center_level_6_cd string, profit_center_level_6_nm string,
        profit_center_level_7_cd string, profit_center_level_7_nm string,
        profit_center_level_8_cd string, profit_center_level_8_nm string,
        profit_center_level_9_cd string, profit_center_level_9_nm string""",
    "version_forecast_mapping": """
        version_forecast_mapping_id long not null, version_nbr string, version_group_nm string,
        active_ind string""",
    "copa_attribution_dim": """
        copa_attribution_id long not null, responsive_business_model_cd string,
        responsive_business_model_desc string, demand_stream_cd string, demand_stream_desc string,
        business_type_cd string, business_type_desc string, marketing_type_cd string,
        marketing_type_desc string, gender_age_cd string, gender_age_desc string,
        direct_business_model_cd string, direct_business_model_desc string,
        product_lifecycle_cd string, product_lifecycle_desc string, quality_cd string,
        quality_desc string, region_summary_product_group_cd string,
        region_summary_product_group_desc string, sales_order_reason_desc string,
        sales_order_type_cd string, sales_order_type_desc string,
        sales_order_type_group_desc string, sales_order_item_category_cd string,
        sales_order_item_category_desc string, distribution_method_cd string,
        distribution_method_desc string, sales_order_reason_cd string""",
    "cost_center_dim_v": """
        cost_center_nbr string not null, controlling_area_cd string, valid_to_dt date,
        valid_from_dt date, iso_language_cd string, cost_center_nm string,
        cost_center_desc string, cost_center_category_hierarchy_1_cd string,
        cost_center_category_hierarchy_2_cd string, company_cd string, source_system string,
        cost_center_type_cd string, cost_center_category_short_desc string,
        business_area_cd string, tax_jurisdiction_cd string, functional_area_cd string,
        currency_cd string, posting_allowed_ind string, planning_allowed_ind string,
        secondary_costs_posting_allowed_ind string, revenue_posting_allowed_ind string,
        commitment_update_allowed_ind string, secondary_costs_planning_allowed_ind string,
        revenue_planning_allowed_ind string, quantity_required_ind string, department_nm string,
        cost_center_report_printer_destination_cd string, company_legal_entity_id string,
        profit_center_nbr string, responsible_user_nm string, responsible_user_id string,
        responsible_user_title string, line_1_nm string, line_2_nm string, line_3_nm string,
        line_4_nm string, country_cd string, region_cd string, city_nm string, district_nm string,
        postal_cd string, street_address_txt string, po_box_postal_cd string, po_box_nbr string,
        correspondence_language_cd string, first_telephone_nbr string,
        second_telephone_nbr string, telebox_nbr string, fax_nbr string, teletex_nbr string,
        telex_nbr string, data_communication_line_nbr string, msg_header_tmst date,
        begin_effective_dt date, end_effective_dt date, cost_center_id long,
        _cost_center_cleansed_latest_load_timestamp date""",
    "DisChannel_cost_center_hierarchy_dim_v": """
        cost_center_hierarchy_hist_id long not null, cost_center_nbr string,
        cost_center_hierarchy_nm string, cost_center_level_1_cd string,
        cost_center_level_1_nm string, cost_center_level_2_cd string,
        cost_center_level_2_nm string, cost_center_level_3_cd string,
        cost_center_level_3_nm string, cost_center_level_4_cd string,
        cost_center_level_4_nm string, cost_center_level_5_cd string,
        cost_center_level_5_nm string, cost_center_level_6_cd string,
        cost_center_level_6_nm string, cost_center_level_7_cd string,
        cost_center_level_7_nm string, cost_center_level_8_cd string,
        cost_center_level_8_nm string, cost_center_level_9_cd string,
        cost_center_level_9_nm string, cost_center_level_10_cd string,
        cost_center_level_10_nm string, cost_center_level_11_cd string,
        cost_center_level_11_nm string, cost_center_level_12_cd string,
        cost_center_level_12_nm string, cost_center_level_13_cd string,
        cost_center_level_13_nm string, cost_center_level_14_cd string,
        cost_center_level_14_nm string, cost_center_level_15_cd string,
        cost_center_level_15_nm string, cost_center_level_16_cd string,
        cost_center_level_16_nm string, cost_center_level_17_cd string,
        cost_center_level_17_nm string, cost_center_level_18_cd string,
        cost_center_level_18_nm string, cost_center_level_19_cd string,
        cost_center_level_19_nm string, cost_center_level_20_cd string,
        cost_center_level_20_nm string, cost_center_level_21_cd string,
        cost_center_level_21_nm string, cost_center_level_22_cd string,
        cost_center_level_22_nm string, cost_center_level_23_cd string,
        cost_center_level_23_nm string, cost_center_level_24_cd string,
        cost_center_level_24_nm string, cost_center_level_25_cd string,
        cost_center_level_25_nm string, cost_center_level_26_cd string,
        cost_center_level_26_nm string, cost_center_level_27_cd string,
        cost_center_level_27_nm string, cost_center_level_28_cd string,
        cost_center_level_28_nm string, cost_center_level_29_cd string,
        cost_center_level_29_nm string, cost_center_level_30_cd string,
        cost_center_level_30_nm string, controlling_area_cd string""",
    "DisChannel_profit_center_hierarchy": """
        profit_center_hierarchy_id long not null, distrchnl_profit_center_nbr string,
        controlling_area_cd string, profit_center_hierarchy_nm string,
        profit_center_level_1_cd string, profit_center_level_1_nm string,
        profit_center_level_2_cd string, profit_center_level_2_nm string,
        profit_center_level_3_cd string, profit_center_level_3_nm string,
        profit_center_level_4_cd string, profit_center_level_4_nm string,
        profit_center_level_5_cd string, profit_center_level_5_nm string,
        profit_center_level_6_cd string, profit_center_level_6_nm string,
        profit_center_level_7_cd string, profit_center_level_7_nm string,
        profit_center_level_8_cd string, profit_center_level_8_nm string,
        profit_center_level_9_cd string, profit_center_level_9_nm string""",
    "division_text": """
        division_id long not null, division_nbr string, division_nm string, division_group string,
        last_row_ind string, common_data_service_view_nm string, source_system_nm string,
        raw_tmst date, record_created_tmst_utc date, record_update_tmst_utc date,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string,
        language_cd string, active_ind string""",
    "division_text_dim_v": """
        division_nbr string not null, division_nm string, division_id long, division_group string""",
    "finance_customer_dim_v": """
        finance_customer_id long not null, customer_nbr string, channel_desc string,
        customer_nm string, customer_owner_group_nm string, marketplace_channel_nm string,
        geo_marketplace_unit_nm string, integrated_business_planning_level_1_desc string,
        integrated_business_planning_level_2_desc string,
        integrated_business_planning_level_3_desc string,
        integrated_business_planning_mpu_desc string, sub_territory_nm string,
        customer_business_type_nm string, customer_subtype_nm string, partner_channel string,
        partner_sub_channel string, partner_account_classification string""",
    "finance_foreign_currency_exchange_rate": """
        finance_foreign_currency_exchange_rate_id long not null, from_currency_cd string,
        exchange_rate_cd string, exchange_rate_nm string, exchange_rate decimal(38,18),
        from_currency_nm string, to_currency_cd string, to_currency_nm string, active_ind string""",
    "finance_product_dim_v": """
        product_id long not null, primary_platform_desc string, style_nm string,
        franchise_nm string, gender_desc string, global_category_core_focus_desc string,
        product_cd string, team_nm string, league_desc string, athlete_full_nm string,
        product_company_nm string, age_desc string, consumer_construct_dimension_nm string,
        fields_of_play_nm string, merchandising_classification_desc string,
        consumer_construct_segment_nm string, brand_nm string, sub_category_desc string,
        blank_usage_ind string, silhouette_desc string, silhouette_type_desc string,
        style_nbr string, consumer_construct_global_consumer_offense_nm string, active_ind string,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string,
        global_sport_focus_derived_desc string, global_sport_focus_desc string,
        global_sport_sub_focus_desc string, sub_brand_desc string, sub_brand_cd string""",
    "functional_area": """
        functional_area_id long not null, language_cd string, functional_area_cd string,
        functional_area_nm string""",
    "general_ledger_fact": """
        general_ledger_fact_id long not null, fiscal_year_period_nbr integer,
        profit_center_id long, division_id long, version_forecast_mapping_id long,
        functional_area_id long, accounting_document_type_id long, product_id long,
        customer_id long, company_id long, copa_attribution_id long, cost_center_nbr string,
        geo_wholesale_value_business_id long, geo_marketplace_channel_id long,
        gl_account_nbr string, zfsm_measure_id long, company_currency_amt decimal(28,5),
        transaction_currency_amt decimal(28,5), performance_management_currency_amt decimal(28,5),
        etm_ind integer, etm_foreign_currency_exchange_rate_id long,
        gaap_foreign_currency_exchange_rate_id long, sales_qty decimal(28,5),
        returns_qty decimal(28,5), general_ledger_fact_ind string, cis_delta_ind string,
        general_ledger_ocogs_allocation_fact_ind string, anaplan_corporate_ind string,
        company_currency_cd string, transaction_currency_cd string, __cost_center_nbr_fk_id long,
        __gl_account_nbr_fk_id long, Functional_Area_cd string,
        accounting_document_type_cd string, profit_center_nbr string, company_cd string""",
    "geo_marketplace_channel_dim": """
        geo_marketplace_channel_id long not null, geo_marketplace_channel_nm string,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string,
        active_ind string""",
    "geo_wholesale_value_business_dim": """
        geo_wholesale_value_business_id long not null, geo_wholesale_value_business_desc string,
        created_by_user_id string, updated_by_user_id string, physical_source_cd string""",
    "gl_account_dim": """
        gl_account_nbr string not null, gl_account_short_desc string, gl_account_long_desc string,
        begin_effective_dt date, end_effective_dt date, active_ind string, gl_accnt_id long,
        cost_component_calc string""",
    "gl_account_hierarchy": """
        gl_account_hierarchy_id long not null, gl_account_nbr string,
        hierarchy_chart_of_accounts_cd string, hierarchy_nm string, hierarchy_liabilty_cd string,
        hierarchy_net_loss_cd string, hierarchy_net_profit_cd string,
        hierarchy_profit_loss_cd string, hierarchy_not_assignable_asset_cd string,
        hierarchy_notes_cd string, hierarchy_cd string, parent_cd string, node_nm string,
        node_cd string, node_gl_account_nbr integer, node_gl_account_to_nbr integer,
        functional_area_assignment_allowed_ind string,
        consolidation_chart_of_accounts_used_ind string, depth_of_leaf_nbr integer,
        depth_of_tree_nbr integer, gl_account_level_1_cd string, gl_account_level_1_nm string,
        gl_account_level_2_cd string, gl_account_level_2_nm string, gl_account_level_3_cd string,
        gl_account_level_3_nm string, gl_account_level_4_cd string, gl_account_level_4_nm string,
        gl_account_level_5_cd string, gl_account_level_5_nm string, gl_account_level_6_cd string,
        gl_account_level_6_nm string, gl_account_level_7_cd string, gl_account_level_7_nm string,
        gl_account_level_8_cd string, gl_account_level_8_nm string, gl_account_level_9_cd string,
        gl_account_level_9_nm string, gl_account_level_10_cd string,
        gl_account_level_10_nm string, gl_account_level_11_cd string,
        gl_account_level_11_nm string, gl_account_level_12_cd string,
        gl_account_level_12_nm string, gl_account_level_13_cd string,
        gl_account_level_13_nm string, gl_account_level_14_cd string,
        gl_account_level_14_nm string, gl_account_level_15_cd string,
        gl_account_level_15_nm string, gl_account_level_16_cd string,
        gl_account_level_16_nm string, gl_account_level_17_cd string,
        gl_account_level_17_nm string, gl_account_level_18_cd string,
        gl_account_level_18_nm string, gl_account_level_19_cd string,
        gl_account_level_19_nm string, gl_account_level_20_cd string,
        gl_account_level_20_nm string, gl_account_level_21_cd string,
        gl_account_level_21_nm string, gl_account_level_22_cd string,
        gl_account_level_22_nm string, gl_account_level_23_cd string,
        gl_account_level_23_nm string, gl_account_level_24_cd string,
        gl_account_level_24_nm string, gl_account_level_25_cd string,
        gl_account_level_25_nm string, gl_account_level_26_cd string,
        gl_account_level_26_nm string, gl_account_level_27_cd string,
        gl_account_level_27_nm string, gl_account_level_28_cd string,
        gl_account_level_28_nm string, gl_account_level_29_cd string,
        gl_account_level_29_nm string, gl_account_level_30_cd string,
        gl_account_level_30_nm string, hierarchy_language_cd string, hierarchy_action_cd string,
        hierarchy_category_cd string,
        top_level_assets_financial_reporting_structure_item_cd string,
        recipient_business_system_id string, sender_business_system_id string,
        item_list_complete_transmission_ind string,
        hierarchy_name_list_complete_transmission_ind string,
        node_name_list_complete_transmission_ind string, sign_reversed_ind string,
        functional_area_list_complete_transmission_ind string,
        gl_account_list_complete_transmission_ind string,
        relationship_list_complete_transmission_ind string, totals_visible_ind string,
        credit_balance_ind string, debit_balance_ind string, created_by_user_id string,
        updated_by_user_id string, physical_source_cd string, gl_account_hierarchy_hist_id long,
        record_created_tmst_utc date, record_update_tmst_utc date,
        _gl_account_hierarchy_cleansed_latest_load_timestamp date""",
    "gl_account_zfsm_measures_hierarchy_dim": """
        zfsm_measure_id long not null, created_by_user_id string, updated_by_user_id string,
        physical_source_cd string, active_ind string, zfsm_measure_cd string,
        zfsm_measure_desc string, gl_account_level_1_cd string, gl_account_level_1_nm string,
        gl_account_level_2_cd string, gl_account_level_2_nm string, gl_account_level_3_cd string,
        gl_account_level_3_nm string, gl_account_level_4_cd string, gl_account_level_4_nm string,
        gl_account_level_5_cd string, gl_account_level_5_nm string, gl_account_level_6_cd string,
        gl_account_level_6_nm string, gl_account_level_7_cd string, gl_account_level_7_nm string,
        gl_account_level_8_cd string, gl_account_level_8_nm string, gl_account_level_9_cd string,
        gl_account_level_9_nm string, gl_account_level_10_cd string,
        gl_account_level_10_nm string, gl_account_level_11_cd string,
        gl_account_level_11_nm string, gl_account_level_12_cd string,
        gl_account_level_12_nm string, gl_account_level_13_cd string,
        gl_account_level_13_nm string, record_created_tmst_utc date, record_update_tmst_utc date""",
    "management_gl_account_hierarchy": """
        gl_account_hierarchy_id long not null, gl_account_nbr string,
        hierarchy_chart_of_accounts_cd string, hierarchy_nm string, hierarchy_liabilty_cd string,
        hierarchy_net_loss_cd string, hierarchy_net_profit_cd string,
        hierarchy_profit_loss_cd string, hierarchy_not_assignable_asset_cd string,
        hierarchy_notes_cd string, hierarchy_cd string, parent_cd string, node_nm string,
        node_cd string, node_gl_account_nbr integer, node_gl_account_to_nbr integer,
        functional_area_assignment_allowed_ind string,
        consolidation_chart_of_accounts_used_ind string, depth_of_leaf_nbr integer,
        depth_of_tree_nbr integer, gl_account_level_1_cd string, gl_account_level_1_nm string,
        gl_account_level_2_cd string, gl_account_level_2_nm string, gl_account_level_3_cd string,
        gl_account_level_3_nm string, gl_account_level_4_cd string, gl_account_level_4_nm string,
        gl_account_level_5_cd string, gl_account_level_5_nm string, gl_account_level_6_cd string,
        gl_account_level_6_nm string, gl_account_level_7_cd string, gl_account_level_7_nm string,
        gl_account_level_8_cd string, gl_account_level_8_nm string, gl_account_level_9_cd string,
        gl_account_level_9_nm string, gl_account_level_10_cd string,
        gl_account_level_10_nm string, gl_account_level_11_cd string,
        gl_account_level_11_nm string, gl_account_level_12_cd string,
        gl_account_level_12_nm string, gl_account_level_13_cd string,
        gl_account_level_13_nm string, gl_account_level_14_cd string,
        gl_account_level_14_nm string, gl_account_level_15_cd string,
        gl_account_level_15_nm string, gl_account_level_16_cd string,
        gl_account_level_16_nm string, gl_account_level_17_cd string,
        gl_account_level_17_nm string, gl_account_level_18_cd string,
        gl_account_level_18_nm string, gl_account_level_19_cd string,
        gl_account_level_19_nm string, gl_account_level_20_cd string,
        gl_account_level_20_nm string, gl_account_level_21_cd string,
        gl_account_level_21_nm string, gl_account_level_22_cd string,
        gl_account_level_22_nm string, gl_account_level_23_cd string,
        gl_account_level_23_nm string, gl_account_level_24_cd string,
        gl_account_level_24_nm string, gl_account_level_25_cd string,
        gl_account_level_25_nm string, gl_account_level_26_cd string,
        gl_account_level_26_nm string, gl_account_level_27_cd string,
        gl_account_level_27_nm string, gl_account_level_28_cd string,
        gl_account_level_28_nm string, gl_account_level_29_cd string,
        gl_account_level_29_nm string, gl_account_level_30_cd string,
        gl_account_level_30_nm string, hierarchy_language_cd string, hierarchy_action_cd string,
        hierarchy_category_cd string,
        top_level_assets_financial_reporting_structure_item_cd string,
        recipient_business_system_id string, sender_business_system_id string,
        item_list_complete_transmission_ind string,
        hierarchy_name_list_complete_transmission_ind string,
        node_name_list_complete_transmission_ind string, sign_reversed_ind string,
        functional_area_list_complete_transmission_ind string,
        gl_account_list_complete_transmission_ind string,
        relationship_list_complete_transmission_ind string, totals_visible_ind string,
        credit_balance_ind string, debit_balance_ind string, created_by_user_id string,
        updated_by_user_id string, physical_source_cd string, hierarchy_cd_nm string""",
    "PartDisChannel_profit_center_hierarchy": """
        profit_center_hierarchy_id long not null, controlling_area_cd string,
        profit_center_hierarchy_nm string, profit_center_level_1_cd string,
        profit_center_level_1_nm string, profit_center_level_2_cd string,
        profit_center_level_2_nm string, profit_center_level_3_cd string,
        profit_center_level_3_nm string, profit_center_level_4_cd string,
        profit_center_level_4_nm string, profit_center_level_5_cd string,
        profit_center_level_5_nm string, profit_center_level_6_cd string,
        profit_center_level_6_nm string, profit_center_level_7_cd string,
        profit_center_level_7_nm string, profit_center_level_8_cd string,
        profit_center_level_8_nm string, profit_center_level_9_cd string,
        profit_center_level_9_nm string, prtrdistrchnl_profit_center_nbr string""",
    "profit_center": """
        profit_center_id long not null, profit_center_nbr string, profit_center_nm string,
        segment_id string, geography_nm string, profit_center_channel_nm string,
        territory_nm string, sub_territory_nm string, begin_effective_dt date,
        end_effective_dt date, active_ind string, geography_sort integer,
        operating_segment_nm string""",
    "retail_global_store_profile_v": """
        address_match_type_name string, store_uuid string, application_reason_desc string,
        brand_cd string, brand_desc string, building_floor_nbr integer, change_timestamp date,
        china_store_sub_channel_cd string, china_store_sub_channel_desc string, city_name string,
        connect_global_store_key_cd string, country_cd string, country_name string,
        create_dt string, customer_city_local_name string, customer_id string,
        customer_local_province_state_name string, customer_nbr string,
        customer_ship_to_name string, dma_cd string, dma_desc string, fixture_type_name string,
        fixture_program_name string, geography_region_name string,
        global_store_channel_class_cd string, global_store_channel_class_desc string,
        greater_china_sub_territory_name string, id string, global_key_city_name string,
        landlord string, change_dt string, lease_expiration_dt string, lease_status_cd string,
        lease_status_desc string, local_language_store_street_address1 string,
        local_language_store_street_address2 string, location_name string, mall_grade string,
        ncx_concept string, nike_selling_space_size_quantity float, original_pos_id integer,
        planned_retail_concept string, pos_id integer, pos_retailer_location_id integer,
        postal_cd string, province_state_name string, real_estate_category_cd string,
        real_estate_category_desc string, record_type string, retail_concept_actual_dt string,
        retail_concept_cd string, retail_concept_desc string, retail_concept_size string,
        retail_concept_target_dt string, retail_concept_volume string,
        ship_to_customer_nbr string, space_uom string, store_city_tier_nbr integer,
        store_close_dt string, store_closure_reason_desc string, store_cd string,
        store_distribution_type_cd string, store_distribution_type_desc string,
        store_district_name string, store_environment_cd string, store_environment_desc string,
        store_front_name_english string, store_front_name_local string, store_hotspot_id string,
        store_hotspot_name_english string, store_hotspot_name_local string,
        store_hotspot_tier_desc string, store_id_kona integer, store_last_open_dt string,
        store_last_renovation_dt string, store_last_renovation_type_cd string,
        store_last_renovation_type_desc string, store_lead_category_cd string,
        store_lead_category_name string, store_level integer, store_name_english string,
        store_name_local string, store_open_dt string, store_priority string,
        store_selling_space_size_quantity float, store_status_cd string, store_status_desc string,
        store_street_address1 string, store_street_address2 string, store_sub_type_cd string,
        store_sub_type_desc string, store_tier_desc string, store_tier_id integer,
        store_total_space_size float, telephone_nbr string, territory_name string,
        total_stories integer, vendor_pos_key string, iso_country_cd string,
        default_transaction_iso_currency_cd string, store_short_name_english string,
        store_master_id string, geography_abbrv string, stream_change_timestamp string,
        space_uom_cd string, store_district_cd string, region_cd string, climate_cd string,
        climate_name string, comparable_status string, real_estate_type_cd string,
        real_estate_type_name string, retail_sales_area_cd string, retail_sales_area_name string,
        retail_sales_district_cd string, retail_sales_district_name string,
        retail_sub_concept_cd string, retail_sub_concept_name string,
        sales_organization_cd string, sales_organization_name string, record_type_cd string,
        territory_cd string, retail_sales_territory_cd string, retail_sales_territory_name string,
        retail_store_district_cd string, retail_store_district_name string,
        banner_division_text string, marketplace_store_tier_cd string,
        marketplace_store_tier_name string, store_score integer,
        partner_store_positioning_cd string, partner_store_positioning_name string,
        geo_key_city_cd string, geo_key_city_name string, key_trade_zone_cd string,
        key_trade_zone_name string""",
}


class Relation(NamedTuple):
    """``child.column`` holds values of ``parent.key``."""

    child: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}.{self.key}"


class Layout(NamedTuple):
    """How a table is written: hive partitions and the columns rows are clustered by."""

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


# The declared foreign keys of the ledger.
RELATIONS = tuple(
    Relation("general_ledger_fact", column, parent, key)
    for column, parent, key in (
        ("accounting_document_type_id", "accounting_document_type", "accounting_document_type_id"),
        ("fiscal_year_period_nbr", "calendar_fiscal_period_v", "fiscal_year_period_nbr"),
        ("profit_center_id", "profit_center", "profit_center_id"),
        ("division_id", "division_text", "division_id"),
        ("version_forecast_mapping_id", "version_forecast_mapping", "version_forecast_mapping_id"),
        ("functional_area_id", "functional_area", "functional_area_id"),
        ("product_id", "finance_product_dim_v", "product_id"),
        ("customer_id", "finance_customer_dim_v", "finance_customer_id"),
        ("company_id", "company_code", "company_id"),
        ("copa_attribution_id", "copa_attribution_dim", "copa_attribution_id"),
        ("cost_center_nbr", "cost_center_dim_v", "cost_center_nbr"),
        (
            "geo_wholesale_value_business_id",
            "geo_wholesale_value_business_dim",
            "geo_wholesale_value_business_id",
        ),
        (
            "geo_marketplace_channel_id",
            "geo_marketplace_channel_dim",
            "geo_marketplace_channel_id",
        ),
        ("gl_account_nbr", "gl_account_dim", "gl_account_nbr"),
    )
)

# Keys that are filled from a parent although no foreign key is declared for them.
DERIVATIONS = (
    Relation(
        "general_ledger_fact",
        "zfsm_measure_id",
        "gl_account_zfsm_measures_hierarchy_dim",
        "zfsm_measure_id",
    ),
    Relation(
        "general_ledger_fact",
        "etm_foreign_currency_exchange_rate_id",
        "finance_foreign_currency_exchange_rate",
        "finance_foreign_currency_exchange_rate_id",
    ),
    Relation(
        "general_ledger_fact",
        "gaap_foreign_currency_exchange_rate_id",
        "finance_foreign_currency_exchange_rate",
        "finance_foreign_currency_exchange_rate_id",
    ),
    Relation("CIS_fact", "profit_center_id", "profit_center", "profit_center_id"),
    Relation("CIS_fact", "gl_account_id", "gl_account_dim", "gl_account_nbr"),
    Relation(
        "CIS_fact", "fiscal_year_period_nbr", "calendar_fiscal_period_v", "fiscal_year_period_nbr"
    ),
    Relation(
        "consolidated_balance_sheet_fact",
        "fiscal_year_period_nbr",
        "calendar_fiscal_period_v",
        "fiscal_year_period_nbr",
    ),
    Relation("division_text_dim_v", "division_id", "division_text", "division_id"),
)

LAYOUTS = {
    "general_ledger_fact": Layout(
        ("fiscal_year_period_nbr",), ("profit_center_id", "gl_account_nbr", "product_id")
    ),
    "CIS_fact": Layout(("fiscal_year_period_nbr",), ("profit_center_id",)),
    "consolidated_balance_sheet_fact": Layout(
        ("fiscal_year_period_nbr",), ("financial_statement_item_cd",)
    ),
    "gl_account_hierarchy": Layout((), ("gl_account_nbr",)),
    "management_gl_account_hierarchy": Layout((), ("gl_account_nbr",)),
}

FACTS = ("CIS_fact", "consolidated_balance_sheet_fact", "general_ledger_fact")
TABLES = tuple(_DECLARED)
DIMENSIONS = tuple(t for t in TABLES if t not in FACTS)

# The income statement declares the account as its key, yet one account has many rows;
# the row id is what identifies a row.  The store profile declares no key.
_ROW_KEYS = {
    "CIS_fact": "consolidated_income_statement_fact_id",
    "retail_global_store_profile_v": "store_uuid",
}


def _parsed(ddl: str) -> T.StructType:
    """The columns of a DDL string, with no session at hand: Spark itself reads the types."""
    parsed = T.StructType()
    for column in re.split(r",\s", ddl):  # the comma in a decimal has no space after it
        name, kind, *not_null = column.split()
        parsed = parsed.add(name, kind, nullable=not not_null)
    return parsed


_SCHEMAS = {table: _parsed(ddl) for table, ddl in _DECLARED.items()}


def schema(table: str) -> T.StructType:
    """The declared schema of a table."""
    return _SCHEMAS[table]


def declared_key(table: str) -> str | None:
    """The column declared as primary key, if there is one."""
    return next((f.name for f in schema(table) if not f.nullable), None)


def row_key(table: str) -> str:
    """The column that identifies a row."""
    return _ROW_KEYS.get(table) or declared_key(table)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Names, order and types as declared; fails on a missing column."""
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema(table)))


def project(
    rows: DataFrame, table: str, columns: Mapping[str, object], nulls: tuple[str, ...] = ()
) -> DataFrame:
    """One select that computes a declared table from ``rows``.

    ``columns`` gives the expression or constant per column and ``nulls`` names those left
    empty; together they must cover the declared columns exactly.
    """
    fields = schema(table)
    given = [*columns, *nulls]
    if sorted(given) != sorted(fields.names):
        odd = set(given) ^ set(fields.names)
        raise ValueError(f"{table}: columns do not match the declaration: {sorted(odd)}")
    return rows.select(
        *(_column(columns.get(f.name)).cast(f.dataType).alias(f.name) for f in fields)
    )


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
