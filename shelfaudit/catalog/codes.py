"""Stand-in codes for the test tables and the periods of the test forms."""

from __future__ import annotations

from shelfaudit.config import AuditCodes

# Fixed values of the test forms: each code of the original mapped onto a
# value that occurs in the analog views (see FIXTURES.md section 2).
TEST_CODES = AuditCodes(
    doc_stock=613,
    doc_order_info=610,
    doc_main_places=608,
    doc_extra_places=612,
    doc_promo=611,
    doc_stock_check=608,
    doc_photo=610,
    fact_doc_types=(613, 610, 608, 612, 611),
    doc_allowlist=(611, 612, 608, 610, 610, 608, 206),
    attr_facing=0,
    attr_shelf=1,
    attr_store=2,
    attr_order_info=2,
    main_places={"shelf": 1, "canoe": 2, "pallet": 3, "cold_showcase": 4, "fridge": 5, "basket": 6},
    extra_places={"racks": 1, "gondola_end": 2, "pallet": 3, "other": 4, "no_extra_place": 5},
    promo_actions={"price_cut": 1, "promo_2plus1": 2, "promo_1plus1": 3, "bundling": 4},
    facing_init_attrs=(0, 1, 2, 3, 4),
    facing_attrs=(0, 1, 2),
    shelf_attrs=(3,),
    store_attrs=(4,),
    obj_banner_attr=611,
    obj_email_attr=633,
    listing_name_parts=("red", "bolt"),
    facing_name_prefixes=("red", "blu", "hot", "sma", "lar", "old"),
)

VISIT_FIRST_DAY, VISIT_LAST_DAY = "1998-01-01", "1998-01-31"
DOC_FIRST_DAY, DOC_LAST_DAY = "1997-01-01", "1999-12-31"
EVENT_DAY = "2024-01-15"
