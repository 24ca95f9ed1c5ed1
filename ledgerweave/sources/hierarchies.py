"""Generators of the hierarchy dimensions: a key and the node it falls under on each level."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import keys, pools
from ledgerweave.functions.exprs import (
    code,
    cyclic_number,
    cyclic_pick,
    every,
    level_nodes,
    nested_level_sizes,
    parent_code,
    shrinking_level_sizes,
)
from ledgerweave.sources.dims import AUDIT
from ledgerweave.sources.schema import project
from ledgerweave.sources.spec import ID, Spec


def level_sizes(spec: Spec, n: int, levels: int, step: int, plus: int = 0) -> list[int]:
    """Node counts per level: nested and growing, or the cyclic style's shrinking ones."""
    if spec.cyclic:
        return shrinking_level_sizes(n, levels, step, plus)
    return nested_level_sizes(n, levels, step)


def _levels(
    sizes: Sequence[int],
    stem: str,
    cd_prefix: Callable[[int], str],
    nm_prefix: Callable[[int], str],
) -> dict[str, Column]:
    """``<stem><level>_cd`` and ``<stem><level>_nm`` for every level."""
    columns: dict[str, Column] = {}
    for level, node in enumerate(level_nodes(F.col(ID), sizes), start=1):
        columns[f"{stem}{level}_cd"] = code(cd_prefix(level), node)
        columns[f"{stem}{level}_nm"] = code(nm_prefix(level), node)
    return columns


def _cost_center_hierarchy(table: str) -> Callable[[DataFrame, int, Spec], DataFrame]:
    def generate(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
        i = F.col(ID)
        return project(
            ids,
            table,
            {
                "cost_center_hierarchy_hist_id": i,
                "cost_center_nbr": keys.cost_center_nbr(i),
                "cost_center_hierarchy_nm": cyclic_pick(pools.REGIONS, i),
                "controlling_area_cd": "1000",
                **_levels(
                    level_sizes(spec, n, 30, 10),
                    "cost_center_level_",
                    lambda level: f"L{level:02d}_",
                    lambda level: f"Level {level} Node ",
                ),
            },
        )

    return generate


def _profit_center_hierarchy(
    table: str, extra: dict[str, Callable[[Column], Column]]
) -> Callable[[DataFrame, int, Spec], DataFrame]:
    """The nine-level template; ``extra`` adds or replaces columns computed from the id."""

    def generate(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
        i = F.col(ID)
        columns = {
            "profit_center_hierarchy_nm": cyclic_pick(pools.REGIONS, i),
            **_levels(
                level_sizes(spec, n, 9, 5),
                "profit_center_level_",
                lambda level: f"PCL{level}_",
                lambda level: f"PC Level {level} - ",
            ),
        }
        columns |= {name: of_id(i) for name, of_id in extra.items()}
        return project(ids, table, columns)

    return generate


segment_cost_center_hierarchy_dim_v = _cost_center_hierarchy("segment_cost_center_hierarchy_dim_v")
dis_channel_cost_center_hierarchy_dim_v = _cost_center_hierarchy(
    "DisChannel_cost_center_hierarchy_dim_v"
)
segment_profit_center_hierarchy = _profit_center_hierarchy(
    "segment_profit_center_hierarchy",
    {
        "segment_profit_center_nbr": lambda i: i.cast("string"),
        "profit_center_hierarchy_nm": lambda i: code("Segment PC Hierarchy ", i),
    },
)
dis_channel_profit_center_hierarchy = _profit_center_hierarchy(
    "DisChannel_profit_center_hierarchy",
    {
        "profit_center_hierarchy_id": lambda i: i,
        "distrchnl_profit_center_nbr": keys.profit_center_nbr,
        "controlling_area_cd": lambda i: "1000",
    },
)
part_dis_channel_profit_center_hierarchy = _profit_center_hierarchy(
    "PartDisChannel_profit_center_hierarchy",
    {
        "profit_center_hierarchy_id": lambda i: i,
        "prtrdistrchnl_profit_center_nbr": keys.profit_center_nbr,
        "controlling_area_cd": lambda i: "1000",
    },
)


def consolidation_functional_area_hierarchy(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    area = keys.functional_area_cd(i)
    loaded = spec.as_of
    return project(
        ids,
        "consolidation_functional_area_hierarchy",
        {
            "consolidation_functional_area_hierarchy_id": i,
            "active_ind": keys.active_unless_every(i, 20),
            "functional_area_cd": area,
            "consolidation_functional_area_hierarchy_parent_cd": parent_code(i, "FA", 4),
            "functional_area_level_nbr": cyclic_number(i, 7, 1),
            "functional_area_type_nm": cyclic_pick(pools.FUNCTIONAL_AREAS, i),
            "consolidation_functional_area_hierarchy_cd": area,
            "consolidation_functional_area_hierarchy_desc": F.concat(
                F.lit("CFA Hierarchy "), area
            ),
            "record_created_tmst_utc": loaded,
            "record_update_tmst_utc": loaded,
            "_consolidation_functional_area_hierarchy_raw_latest_load_tmst": loaded,
            **AUDIT,
            **_levels(
                level_sizes(spec, n, 7, 5, plus=1),
                "consolidation_functional_area_",
                lambda level: f"CFA{level}_",
                lambda level: f"CFA Level {level} ",
            ),
        },
    )


def consolidation_segment_hierarchy_dim(ids: DataFrame, n: int, spec: Spec) -> DataFrame:
    i = F.col(ID)
    cd = code("CSH", i, 5)
    description = F.concat(F.lit("Cons Segment Hierarchy "), cd)
    levels = _levels(
        level_sizes(spec, n, 10, 4),
        "consolidation_segment_",
        lambda level: f"SEG{level}_",
        lambda level: f"Segment Level {level} - ",
    )
    for level in range(1, 11):
        stem = f"consolidation_segment_{level}"
        levels[f"{stem}_cd_nm"] = F.concat(
            levels[f"{stem}_cd"], F.lit(" - "), levels[f"{stem}_nm"]
        )
    return project(
        ids,
        "consolidation_segment_hierarchy_dim",
        {
            "consolidation_segment_hierarchy_id": i,
            "segment_nbr": cyclic_number(i, 100, 1),
            "segment_desc": cyclic_pick(pools.PROFIT_CENTER_SEGMENTS, i),
            "consolidation_segment_hierarchy_parent_cd": parent_code(i, "SEG", 3),
            "segment_type_nm": cyclic_pick(pools.SEGMENT_TYPES, i),
            "segment_level_nbr": cyclic_number(i, 10, 1),
            "consolidation_segment_hierarchy_cd": cd,
            "consolidation_segment_hierarchy_desc": description,
            "consolidation_segment_hierarchy_cd_desc": F.concat(cd, F.lit(" - "), description),
            "active_ind": "Y",
            **AUDIT,
            **levels,
        },
    )


_ACCOUNT_HIERARCHY_NULLS = (
    "hierarchy_liabilty_cd",
    "hierarchy_net_loss_cd",
    "hierarchy_net_profit_cd",
    "hierarchy_profit_loss_cd",
    "hierarchy_not_assignable_asset_cd",
    "hierarchy_notes_cd",
    "top_level_assets_financial_reporting_structure_item_cd",
)
_ACCOUNT_HIERARCHY_SET = (
    "functional_area_assignment_allowed_ind",
    "consolidation_chart_of_accounts_used_ind",
    "totals_visible_ind",
    "item_list_complete_transmission_ind",
    "hierarchy_name_list_complete_transmission_ind",
    "node_name_list_complete_transmission_ind",
    "functional_area_list_complete_transmission_ind",
    "gl_account_list_complete_transmission_ind",
    "relationship_list_complete_transmission_ind",
)


def _account_hierarchy(n: int, spec: Spec, accounts: int) -> dict[str, Column]:
    i = F.col(ID)
    if spec.cyclic:
        account = cyclic_number(i, 8_000, 1_000_000).cast("string")
        first_account = cyclic_number(i, 7_000, 1_000_000)
    else:
        account = keys.gl_account_nbr(cyclic_number(i, accounts, 1))
        # The declared type is an int: the account's seven digits, without its round.
        first_account = F.pmod(account.cast("bigint"), F.lit(keys.ROUND)).cast("int")
    return {
        "gl_account_hierarchy_id": i,
        "gl_account_nbr": account,
        "hierarchy_chart_of_accounts_cd": cyclic_pick(pools.CHARTS_OF_ACCOUNTS, i),
        "hierarchy_nm": cyclic_pick(pools.ACCOUNT_HIERARCHIES, i),
        "hierarchy_cd": code("H", cyclic_number(i, 20, 1), 3),
        "parent_cd": code("P", cyclic_number(i, 50, 1), 4),
        "node_nm": code("Node ", i),
        "node_cd": code("N", i, 6),
        "node_gl_account_nbr": first_account,
        "node_gl_account_to_nbr": first_account + 100,
        "depth_of_leaf_nbr": cyclic_number(i, 8, 1),
        "depth_of_tree_nbr": 30,
        "hierarchy_language_cd": "EN",
        "hierarchy_action_cd": "U",
        "hierarchy_category_cd": "GL",
        "recipient_business_system_id": "ECC_PROD",
        "sender_business_system_id": "ECC_PROD",
        "sign_reversed_ind": every(i, 5, "X", ""),
        "credit_balance_ind": every(i, 3, "X", ""),
        "debit_balance_ind": every(i, 3, "", "X"),
        **{name: "X" for name in _ACCOUNT_HIERARCHY_SET},
        **AUDIT,
        **_levels(
            level_sizes(spec, n, 30, 3),
            "gl_account_level_",
            lambda level: f"GL{level}_",
            lambda level: f"GL Level {level} - ",
        ),
    }


def gl_account_hierarchy(
    ids: DataFrame, n: int, spec: Spec, accounts: int = pools.DEFAULT_ROWS["gl_account_dim"]
) -> DataFrame:
    loaded = spec.as_of
    columns = _account_hierarchy(n, spec, accounts) | {
        "gl_account_hierarchy_hist_id": F.col(ID),
        "record_created_tmst_utc": loaded,
        "record_update_tmst_utc": loaded,
        "_gl_account_hierarchy_cleansed_latest_load_timestamp": loaded,
    }
    return project(ids, "gl_account_hierarchy", columns, _ACCOUNT_HIERARCHY_NULLS)


def management_gl_account_hierarchy(
    ids: DataFrame, n: int, spec: Spec, accounts: int = pools.DEFAULT_ROWS["gl_account_dim"]
) -> DataFrame:
    columns = _account_hierarchy(n, spec, accounts) | {
        "hierarchy_cd_nm": code("H", F.col(ID), 3),
    }
    return project(ids, "management_gl_account_hierarchy", columns, _ACCOUNT_HIERARCHY_NULLS)
