"""Generators of the lookup, organisation, product, customer and account dimensions.

Each takes a DataFrame of 1-based ids, the number of ids and the run's spec, and returns a
lazy DataFrame in the declared schema: one select over the ids, without a shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import keys, pools
from ledgerweave.functions.exprs import (
    case,
    code,
    cyclic_number,
    cyclic_pick,
    every,
    level_nodes,
    literal_array,
    number_after_round,
    zero_pad,
)
from ledgerweave.functions.rng import expand_weights
from ledgerweave.sources.schema import project, schema
from ledgerweave.sources.spec import ID, Spec

EFFECTIVE_FROM = dt.date(2015, 1, 1)
EFFECTIVE_TO = dt.date(2099, 12, 31)
LOADER = "ETL_SERVICE"
SOURCE = "SAP_ECC"
AUDIT = {"created_by_user_id": LOADER, "updated_by_user_id": LOADER, "physical_source_cd": SOURCE}


def _weighted(spec: Spec, table: str, salt: str, values, weights) -> Column:
    if spec.cyclic:
        return cyclic_pick(expand_weights(values, weights), F.col(ID))
    return spec.random(table).weighted(salt, values, weights)


def _firsts(pairs) -> list:
    return [first for first, _ in pairs]


def _seconds(pairs) -> list:
    return [second for _, second in pairs]


def accounting_document_type(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    listed = len(pools.DOCUMENT_TYPES)
    cd = keys.document_type_cd(i)
    name = F.when(
        i <= listed, F.get(literal_array(_seconds(pools.DOCUMENT_TYPES)), (i - 1).cast("int"))
    ).otherwise(F.concat(F.lit("Custom Document Type "), i.cast("string")))
    return project(
        ids,
        "accounting_document_type",
        {
            "accounting_document_type_id": i,
            "accounting_document_type_cd": cd,
            "accounting_document_type_nm": name,
            "active_ind": "Y",
            "language_cd": "EN",
            "accounting_document_type_cd_nm": F.concat(
                cd, F.lit(" - "), F.replace(name, F.lit(" – "), F.lit(" "))
            ),
        },
    )


def atscale_geo_security(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    region = F.get(literal_array(pools.SECURITY_REGIONS), (i - 1).cast("int"))
    return project(
        ids,
        "atscale_geo_security",
        {
            "region": region,
            "role": F.concat(F.lit("ROLE_"), F.translate(F.upper(region), " ", "_")),
        },
    )


def version_forecast_mapping(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    return project(
        ids,
        "version_forecast_mapping",
        {
            "version_forecast_mapping_id": i,
            "version_nbr": keys.version_nbr(i),
            "version_group_nm": keys.version_group(i),
            "active_ind": "Y",
        },
    )


def functional_area(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    names = pools.FUNCTIONAL_AREAS
    round_nbr = F.floor((i - 1) / len(names)) + 1
    return project(
        ids,
        "functional_area",
        {
            "functional_area_id": i,
            "language_cd": "EN",
            "functional_area_cd": keys.functional_area_cd(i),
            "functional_area_nm": F.concat(
                cyclic_pick(names, i - 1), number_after_round(i, len(names), round_nbr)
            ),
        },
    )


def division_text(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    group = cyclic_pick(pools.DIVISION_GROUPS, i - 1)
    nbr = keys.division_nbr(i)
    loaded = spec.as_of
    return project(
        ids,
        "division_text",
        {
            "division_id": i,
            "division_nbr": nbr,
            "division_nm": F.concat(group, F.lit(" Division "), nbr),
            "division_group": group,
            "last_row_ind": "Y",
            "common_data_service_view_nm": "DIVISION_V",
            "source_system_nm": SOURCE,
            "raw_tmst": loaded,
            "record_created_tmst_utc": loaded,
            "record_update_tmst_utc": loaded,
            "language_cd": "EN",
            "active_ind": "Y",
            **AUDIT,
        },
    )


def division_text_dim_v(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    divisions = division_text(ids, n, spec)
    columns = schema("division_text_dim_v").names
    return project(divisions, "division_text_dim_v", {c: F.col(c) for c in columns})


def exchange_rate(from_currency: Column, to_currency: Column) -> Column:
    """Target units per source unit, both quoted per US dollar, to eight places."""
    per_usd = pools.UNITS_PER_USD
    quoted = F.create_map(*(F.lit(x) for pair in per_usd.items() for x in pair))

    def units(currency: Column) -> Column:
        return F.coalesce(F.try_element_at(quoted, currency), F.lit(1.0))

    ratio = F.round(units(to_currency) / units(from_currency), 8)
    return F.when(from_currency == to_currency, F.lit(1.0)).otherwise(ratio)


def finance_foreign_currency_exchange_rate(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    """Currencies x rate types x targets, numbered in nesting order: the id is the position."""
    i = F.col(ID)
    targets, types = pools.RATE_TARGETS, pools.RATE_TYPES
    per_currency = len(types) * len(targets)
    position = i - 1
    from_cd = cyclic_pick(pools.CURRENCIES, F.floor(position / per_currency))
    type_position = F.floor(position / len(targets))
    to_cd = cyclic_pick(targets, position)
    return project(
        ids,
        "finance_foreign_currency_exchange_rate",
        {
            "finance_foreign_currency_exchange_rate_id": i,
            "from_currency_cd": from_cd,
            "exchange_rate_cd": cyclic_pick(_firsts(types), type_position),
            "exchange_rate_nm": cyclic_pick(_seconds(types), type_position),
            "exchange_rate": exchange_rate(from_cd, to_cd).cast("decimal(28,8)"),
            "from_currency_nm": from_cd,
            "to_currency_cd": to_cd,
            "to_currency_nm": to_cd,
            "active_ind": "Y",
        },
    )


def company_code(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    names = _firsts(pools.COMPANIES)
    return project(
        ids,
        "company_code",
        {
            "company_id": i,
            "company_cd": keys.company_cd(i),
            "company_nm": F.concat(
                cyclic_pick(names, i - 1), number_after_round(i, len(names), i)
            ),
            "currency_cd": keys.company_currency(i),
            **AUDIT,
        },
    )


def finance_product_dim_v(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    table, i = "finance_product_dim_v", F.col(ID)
    brand = _weighted(spec, table, "brand", pools.BRANDS, pools.BRAND_WEIGHTS)
    category = _weighted(spec, table, "category", pools.CATEGORIES, pools.CATEGORY_WEIGHTS)
    gender = _weighted(spec, table, "gender", pools.GENDERS, pools.GENDER_WEIGHTS)
    picked = ids.select(ID, brand.alias("brand"), category.alias("category"), gender.alias("sex"))
    brand = F.col("brand")
    platform = cyclic_pick(pools.PLATFORMS, i)
    franchise = cyclic_pick(pools.FRANCHISES, i)
    style = code("STY", cyclic_number(i, 900_000, 100_000), 6)
    brand_cd = F.substring(brand, 1, 2)
    return project(
        picked,
        table,
        {
            "product_id": i,
            "primary_platform_desc": platform,
            "style_nm": F.concat(franchise, F.lit(" "), style),
            "franchise_nm": franchise,
            "gender_desc": F.col("sex"),
            "global_category_core_focus_desc": cyclic_pick(pools.CORE_FOCUSES, i),
            "product_cd": F.concat(brand_cd, F.lit("-"), zero_pad(i, 8)),
            "team_nm": cyclic_pick(pools.TEAMS, i),
            "league_desc": cyclic_pick(pools.LEAGUES, i),
            "athlete_full_nm": cyclic_pick(pools.ATHLETES, i),
            "product_company_nm": brand,
            "age_desc": cyclic_pick(pools.AGES, i),
            "consumer_construct_dimension_nm": cyclic_pick(pools.DIVISION_GROUPS, i),
            "fields_of_play_nm": platform,
            "merchandising_classification_desc": cyclic_pick(pools.MERCHANDISING_CLASSES, i),
            "consumer_construct_segment_nm": cyclic_pick(pools.CONSTRUCT_SEGMENTS, i),
            "brand_nm": brand,
            "sub_category_desc": F.col("category"),
            "blank_usage_ind": "N",
            "silhouette_desc": cyclic_pick(pools.SILHOUETTES, i),
            "silhouette_type_desc": cyclic_pick(pools.SILHOUETTE_TYPES, i),
            "style_nbr": style,
            "consumer_construct_global_consumer_offense_nm": cyclic_pick(
                pools.CONSUMER_OFFENSES, i
            ),
            "active_ind": keys.active_unless_every(i, 50),
            "global_sport_focus_derived_desc": platform,
            "global_sport_focus_desc": platform,
            "global_sport_sub_focus_desc": F.concat(platform, F.lit(" - Sub")),
            "sub_brand_desc": brand,
            "sub_brand_cd": brand_cd,
            **AUDIT,
        },
    )


def finance_customer_dim_v(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    table, i = "finance_customer_dim_v", F.col(ID)
    picked = ids.select(
        ID,
        _weighted(
            spec, table, "channel", pools.CUSTOMER_CHANNELS, pools.CUSTOMER_CHANNEL_WEIGHTS
        ).alias("channel"),
    )
    channel = F.col("channel")
    marketplace = cyclic_pick(pools.MARKETPLACE_CHANNELS, i)
    region = cyclic_pick(pools.REGIONS, i)
    return project(
        picked,
        table,
        {
            "finance_customer_id": i,
            "customer_nbr": keys.customer_nbr(i),
            "channel_desc": channel,
            "customer_nm": F.concat(channel, F.lit(" Customer "), i.cast("string")),
            "customer_owner_group_nm": region,
            "marketplace_channel_nm": marketplace,
            "geo_marketplace_unit_nm": region,
            "integrated_business_planning_level_1_desc": region,
            "integrated_business_planning_level_2_desc": channel,
            "integrated_business_planning_level_3_desc": F.concat(channel, F.lit(" Detail")),
            "integrated_business_planning_mpu_desc": region,
            "sub_territory_nm": F.concat(
                region, F.lit(" Sub-"), cyclic_number(i, 10, 1).cast("string")
            ),
            "customer_business_type_nm": cyclic_pick(pools.CUSTOMER_BUSINESS_TYPES, i),
            "customer_subtype_nm": cyclic_pick(pools.CUSTOMER_SUBTYPES, i),
            "partner_channel": channel,
            "partner_sub_channel": marketplace,
            "partner_account_classification": cyclic_pick(pools.ACCOUNT_TIERS, i),
        },
    )


def copa_attribution_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    copied = {
        "responsive_business_model": pools.BUSINESS_MODELS,
        "demand_stream": pools.DEMAND_STREAMS,
        "business_type": pools.ATTRIBUTION_BUSINESS_TYPES,
        "marketing_type": pools.MARKETING_TYPES,
        "gender_age": pools.GENDER_AGES,
        "direct_business_model": pools.BUSINESS_MODELS,
        "product_lifecycle": pools.LIFECYCLES,
        "quality": pools.QUALITIES,
        "distribution_method": pools.DISTRIBUTION_METHODS,
    }
    columns = {"copa_attribution_id": i}
    for name, pool in copied.items():
        columns[f"{name}_cd"] = columns[f"{name}_desc"] = cyclic_pick(pool, i)
    order_type = cyclic_pick(pools.SALES_ORDER_TYPES, i)
    item_category = cyclic_pick(pools.SALES_ITEM_CATEGORIES, i)
    reason = zero_pad(cyclic_number(i, 20, 1), 2)
    columns |= {
        "region_summary_product_group_cd": cyclic_pick(_firsts(pools.PRODUCT_GROUPS), i),
        "region_summary_product_group_desc": cyclic_pick(_seconds(pools.PRODUCT_GROUPS), i),
        "sales_order_type_cd": order_type,
        "sales_order_type_desc": F.concat(order_type, F.lit(" Order")),
        "sales_order_type_group_desc": columns["business_type_desc"],
        "sales_order_item_category_cd": item_category,
        "sales_order_item_category_desc": F.concat(item_category, F.lit(" - Standard")),
        "sales_order_reason_cd": reason,
        "sales_order_reason_desc": F.concat(F.lit("Reason "), reason),
    }
    return project(ids, "copa_attribution_dim", columns)


def cost_center_dim_v(
    ids: DataFrame,
    n: int,
    spec: Spec,
    companies: int = pools.DEFAULT_ROWS["company_code"],
    profit_centers: int = pools.DEFAULT_ROWS["profit_center"],
    functional_areas: int = pools.DEFAULT_ROWS["functional_area"],
) -> DataFrame:
    i = F.col(ID)
    region = cyclic_pick(pools.REGIONS, i)
    country = cyclic_pick(pools.COUNTRIES, i)
    city = cyclic_pick(pools.COST_CENTER_CITIES, i)
    name = F.concat(region, F.lit(" Cost Center "), i.cast("string"))
    allowed, system = "X", "SYSTEM"
    loaded = spec.as_of
    return project(
        ids,
        "cost_center_dim_v",
        {
            "cost_center_nbr": keys.cost_center_nbr(i),
            "controlling_area_cd": "1000",
            "valid_to_dt": EFFECTIVE_TO,
            "valid_from_dt": EFFECTIVE_FROM,
            "iso_language_cd": "EN",
            "cost_center_nm": name,
            "cost_center_desc": F.concat(F.lit("Description for "), name),
            "cost_center_category_hierarchy_1_cd": cyclic_pick(
                _firsts(pools.COST_CENTER_CATEGORIES), i
            ),
            "cost_center_category_hierarchy_2_cd": cyclic_pick(
                _seconds(pools.COST_CENTER_CATEGORIES), i
            ),
            "company_cd": keys.company_cd(cyclic_number(i, companies, 1)),
            "source_system": SOURCE,
            "cost_center_type_cd": cyclic_pick(_firsts(pools.COST_CENTER_TYPES), i),
            "cost_center_category_short_desc": cyclic_pick(_seconds(pools.COST_CENTER_TYPES), i),
            "business_area_cd": code("BA", cyclic_number(i, 10, 1), 2),
            "tax_jurisdiction_cd": F.concat(country, F.lit("0000000")),
            "functional_area_cd": keys.functional_area_cd(cyclic_number(i, functional_areas, 1)),
            "currency_cd": cyclic_pick(pools.COST_CENTER_CURRENCIES, i),
            "posting_allowed_ind": allowed,
            "planning_allowed_ind": allowed,
            "secondary_costs_posting_allowed_ind": allowed,
            "revenue_posting_allowed_ind": every(i, 3, "X", ""),
            "commitment_update_allowed_ind": allowed,
            "secondary_costs_planning_allowed_ind": allowed,
            "revenue_planning_allowed_ind": every(i, 3, "X", ""),
            "quantity_required_ind": every(i, 5, "X", ""),
            "department_nm": code("Dept-", cyclic_number(i, 20, 1)),
            "profit_center_nbr": keys.profit_center_nbr(cyclic_number(i, profit_centers, 1)),
            "responsible_user_nm": system,
            "responsible_user_id": system,
            "line_1_nm": name,
            "country_cd": country,
            "region_cd": region,
            "city_nm": city,
            "postal_cd": zero_pad(cyclic_number(i, 90_000, 10_000), 5),
            "street_address_txt": F.concat(F.lit("100 Commerce Way, "), city),
            "correspondence_language_cd": "EN",
            "msg_header_tmst": loaded,
            "begin_effective_dt": EFFECTIVE_FROM,
            "end_effective_dt": EFFECTIVE_TO,
            "cost_center_id": i,
            "_cost_center_cleansed_latest_load_timestamp": loaded,
        },
        nulls=(
            "cost_center_report_printer_destination_cd",
            "company_legal_entity_id",
            "responsible_user_title",
            "line_2_nm",
            "line_3_nm",
            "line_4_nm",
            "district_nm",
            "po_box_postal_cd",
            "po_box_nbr",
            "first_telephone_nbr",
            "second_telephone_nbr",
            "telebox_nbr",
            "fax_nbr",
            "teletex_nbr",
            "telex_nbr",
            "data_communication_line_nbr",
        ),
    )


def profit_center(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    region = cyclic_pick(pools.REGIONS, i)
    channel = cyclic_pick(pools.PROFIT_CENTER_CHANNELS, i)
    return project(
        ids,
        "profit_center",
        {
            "profit_center_id": i,
            "profit_center_nbr": keys.profit_center_nbr(i),
            "profit_center_nm": F.concat(
                cyclic_pick(pools.PROFIT_CENTER_SEGMENTS, i),
                F.lit(" "),
                channel,
                F.lit(" PC-"),
                i.cast("string"),
            ),
            "segment_id": code("SEG", cyclic_number(i, 50, 1), 3),
            "geography_nm": region,
            "profit_center_channel_nm": channel,
            "territory_nm": F.concat(region, F.lit(" Territory")),
            "sub_territory_nm": F.concat(
                region, F.lit(" Sub-Territory-"), cyclic_number(i, 10, 1).cast("string")
            ),
            "begin_effective_dt": EFFECTIVE_FROM,
            "end_effective_dt": EFFECTIVE_TO,
            "active_ind": keys.active_unless_every(i, 20),
            "geography_sort": cyclic_number(i, 100, 1),
            "operating_segment_nm": cyclic_pick(pools.OPERATING_SEGMENTS, i),
        },
    )


def gl_account_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    labels = [c.label for c in pools.ACCOUNT_CLASSES]
    label = (
        cyclic_pick(labels, i)
        if spec.cyclic
        else keys.of_class(keys.account_class_index(i), labels)
    )
    numbered = ids.select(
        ID, label.alias("label"), keys.gl_account_nbr(i, spec.style).alias("nbr")
    )
    short = F.concat(F.col("label"), F.lit(" Acct "), F.col("nbr"))
    return project(
        numbered,
        "gl_account_dim",
        {
            "gl_account_nbr": F.col("nbr"),
            "gl_account_short_desc": short,
            "gl_account_long_desc": F.concat(F.lit("General Ledger Account - "), short),
            "begin_effective_dt": EFFECTIVE_FROM,
            "end_effective_dt": EFFECTIVE_TO,
            "active_ind": keys.active_unless_every(i, 100),
            "gl_accnt_id": i,
        },
        nulls=("cost_component_calc",),
    )


def gl_account_zfsm_measures_hierarchy_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    cd = code("ZFSM", i, 6)
    loaded = spec.as_of
    columns = {
        "zfsm_measure_id": i,
        "active_ind": keys.active_unless_every(i, 50),
        "zfsm_measure_cd": cd,
        "zfsm_measure_desc": F.concat(cyclic_pick(pools.MEASURES, i), F.lit(" - "), cd),
        "record_created_tmst_utc": loaded,
        "record_update_tmst_utc": loaded,
        **AUDIT,
    }
    # Each size is a multiple of the one above, so that every node has one parent.
    sizes = (10, 20, 30) if spec.cyclic else (10, 20, 40)
    for level, node in enumerate(level_nodes(i, sizes), start=1):
        level_cd = code(f"L{level}_", node)
        columns[f"gl_account_level_{level}_cd"] = level_cd
        columns[f"gl_account_level_{level}_nm"] = F.concat(F.lit(f"Level {level} - "), level_cd)
    unused = tuple(
        f"gl_account_level_{level}_{part}" for level in range(4, 14) for part in ("cd", "nm")
    )
    return project(ids, "gl_account_zfsm_measures_hierarchy_dim", columns, unused)


def geo_marketplace_channel_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    return project(
        ids,
        "geo_marketplace_channel_dim",
        {
            "geo_marketplace_channel_id": i,
            "geo_marketplace_channel_nm": F.concat(
                cyclic_pick(pools.REGIONS, i - 1),
                F.lit(" - "),
                cyclic_pick(pools.MARKETPLACE_CHANNELS, i - 1),
            ),
            "active_ind": "Y",
            **AUDIT,
        },
    )


def geo_wholesale_value_business_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    return project(
        ids,
        "geo_wholesale_value_business_dim",
        {
            "geo_wholesale_value_business_id": i,
            "geo_wholesale_value_business_desc": F.concat(
                cyclic_pick(pools.REGIONS, i - 1),
                F.lit(" Wholesale "),
                cyclic_pick(pools.WHOLESALE_TIERS, i - 1),
            ),
            **AUDIT,
        },
    )


# The store profile's columns that stay empty.
EMPTY_STORE_COLUMNS = (
    "address_match_type_name", "application_reason_desc", "building_floor_nbr",
    "china_store_sub_channel_cd", "china_store_sub_channel_desc", "connect_global_store_key_cd",
    "customer_city_local_name", "customer_id", "customer_local_province_state_name",
    "customer_nbr", "customer_ship_to_name", "dma_cd", "dma_desc", "fixture_type_name",
    "fixture_program_name", "global_store_channel_class_cd", "global_store_channel_class_desc",
    "greater_china_sub_territory_name", "id", "global_key_city_name", "landlord", "change_dt",
    "lease_expiration_dt", "lease_status_cd", "lease_status_desc",
    "local_language_store_street_address1", "local_language_store_street_address2",
    "location_name", "mall_grade", "ncx_concept", "original_pos_id", "planned_retail_concept",
    "pos_retailer_location_id", "postal_cd", "province_state_name", "real_estate_category_cd",
    "real_estate_category_desc", "record_type", "retail_concept_actual_dt", "retail_concept_size",
    "retail_concept_target_dt", "retail_concept_volume", "ship_to_customer_nbr",
    "store_city_tier_nbr", "store_close_dt", "store_closure_reason_desc",
    "store_distribution_type_cd", "store_distribution_type_desc", "store_district_name",
    "store_environment_cd", "store_environment_desc", "store_front_name_english",
    "store_front_name_local", "store_hotspot_id", "store_hotspot_name_english",
    "store_hotspot_name_local", "store_hotspot_tier_desc", "store_last_open_dt",
    "store_last_renovation_dt", "store_last_renovation_type_cd",
    "store_last_renovation_type_desc", "store_lead_category_cd", "store_lead_category_name",
    "store_name_local", "store_priority", "store_street_address1", "store_street_address2",
    "store_sub_type_cd", "store_sub_type_desc", "telephone_nbr", "total_stories",
    "vendor_pos_key", "store_short_name_english", "store_master_id", "geography_abbrv",
    "stream_change_timestamp", "store_district_cd", "climate_cd", "climate_name",
    "real_estate_type_cd", "real_estate_type_name", "retail_sales_area_cd",
    "retail_sales_area_name", "retail_sales_district_cd", "retail_sales_district_name",
    "retail_sub_concept_cd", "retail_sub_concept_name", "sales_organization_cd",
    "sales_organization_name", "record_type_cd", "territory_cd", "retail_sales_territory_cd",
    "retail_sales_territory_name", "retail_store_district_cd", "retail_store_district_name",
    "banner_division_text", "marketplace_store_tier_cd", "marketplace_store_tier_name",
    "store_score", "partner_store_positioning_cd", "partner_store_positioning_name",
    "geo_key_city_cd", "geo_key_city_name", "key_trade_zone_cd", "key_trade_zone_name",
)


def retail_global_store_profile_v(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    table, i = "retail_global_store_profile_v", F.col(ID)
    sized = ids.select(
        ID, spec.random(table).between("area", 500, 10_500).cast("float").alias("area")
    )
    brand_cd = cyclic_pick(_firsts(pools.STORE_BRANDS), i)
    brand = cyclic_pick(_seconds(pools.STORE_BRANDS), i)
    country = cyclic_pick(pools.COUNTRIES, i)
    region = cyclic_pick(pools.REGIONS, i)
    tier = cyclic_number(i, 4, 1)
    opened, square_feet = "2015-01-01", "SQF"
    closed, paused = F.pmod(i, F.lit(15)) == 0, F.pmod(i, F.lit(20)) == 0
    status = [("CLOSED", "Permanently Closed"), ("TEMP_CLOSED", "Temporarily Closed")]
    status_cd, status_desc = (
        case(((closed, F.lit(a)), (paused, F.lit(b))), F.lit(other))
        for (a, b), other in ((_firsts(status), "OPEN"), (_seconds(status), "Open"))
    )
    columns = {
        "store_uuid": code("STR-", i, 8),
        "brand_cd": brand_cd,
        "brand_desc": brand,
        "change_timestamp": spec.as_of,
        "city_name": cyclic_pick(pools.STORE_CITIES, i),
        "country_cd": country,
        "country_name": country,
        "create_dt": opened,
        "geography_region_name": region,
        "nike_selling_space_size_quantity": F.col("area"),
        "pos_id": i,
        "retail_concept_cd": cyclic_pick(_firsts(pools.RETAIL_CONCEPTS), i),
        "retail_concept_desc": cyclic_pick(_seconds(pools.RETAIL_CONCEPTS), i),
        "space_uom": square_feet,
        "store_cd": F.concat(brand_cd, zero_pad(i, 6)),
        "store_id_kona": i,
        "store_level": cyclic_number(i, 5, 1),
        "store_name_english": F.concat(brand, F.lit(" Store "), i.cast("string")),
        "store_open_dt": opened,
        "store_selling_space_size_quantity": F.col("area"),
        "store_status_cd": status_cd,
        "store_status_desc": status_desc,
        "store_tier_desc": code("Tier ", tier),
        "store_tier_id": tier,
        "store_total_space_size": F.col("area").cast("double") * 1.3,
        "territory_name": region,
        "iso_country_cd": country,
        "default_transaction_iso_currency_cd": cyclic_pick(pools.STORE_CURRENCIES, i),
        "space_uom_cd": square_feet,
        "region_cd": region,
        "comparable_status": every(i, 3, "Non-Comparable", "Comparable"),
    }
    return project(sized, table, columns, EMPTY_STORE_COLUMNS)
