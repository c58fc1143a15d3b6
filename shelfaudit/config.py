"""Domain codes and report labels, passed to every pipeline as data.

The library holds no domain literal of its own. ``REFERENCE_CODES`` is the
configuration of the original daily regional audit report; tests and the
query catalogue use a stand-in configuration built on the test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ReportLabels:
    """Constant text columns of the report (section markers, placeholders)."""

    # Section markers and the "empty" placeholder of the
    # original report, in column order.
    open_613: str = "613ый документ=>"
    close_613: str = "<=613ый документ"
    open_610: str = "610ый документ=>"
    close_610: str = "<=610ый документ"
    open_608: str = "608-ой документ=>"
    close_608: str = "<=608-ой документ"
    open_612: str = "612-ый документ=>"
    close_612: str = "<=612-ый документ"
    open_611: str = "611-ый документ=>"
    close_611: str = "<=611-ый документ"
    empty: str = "ПУСТО"
    photo_extension: str = ".jpg"


DEFAULT_ADDRESS_FIELDS = {
    "gorod": r"г\.\s*([^,]+)",
    "street": r"ул\.\s*([^,]+)",
    "dom": r"д\.\s*([^,]+)",
    "nomertt": r"№\s*([0-9]+)",
}


# Column codes of the original's extracts, in the order of their
# columns; one code of the outlets and persons has no column.
VISIT_CODES = {1: "ownerdistid", 2: "masterfid", 3: "fid", 4: "vdate", 5: "datebegin", 6: "dateend", 12: "otkazstr",
               13: "pda", 14: "vdateonly"}
FACE_CODES = {1: "fid", 2: "fname", 3: "exid", 17: "ftype", 21: "ownerdistid", 20: "faddress", 6: None}
DOCUMENT_CODES = {6: "masterfid", 1: "orid", 7: "ordate", 20: "ownerdistid", 12: "mfid", 13: "ufid", 5: "ortype",
                  22: "masterdocid", 17: "orcomment"}


@dataclass(frozen=True)
class AuditCodes:
    """All codes one report run depends on.

    Pivot maps are ``output column name -> code`` and keep their order.
    """

    # document types
    doc_stock: int                      # 613: assortment and stock lines
    doc_order_info: int                 # 610: order information
    doc_main_places: int                # 608: main sales places
    doc_extra_places: int               # 612: extra display places
    doc_promo: int                      # 611: trade-marketing actions
    doc_stock_check: int                # 607: stock check (staging / full report)
    doc_photo: int                      # 230: photo report
    fact_doc_types: tuple[int, ...]     # document types kept in the order facts
    doc_allowlist: tuple[int, ...]      # document types of the document extract
    # document line attributes
    attr_facing: int                    # 620
    attr_shelf: int                     # 634
    attr_store: int                     # 635
    attr_order_info: int                # 602
    # pivots: output name -> object id (608) or attribute id (612, 611)
    main_places: dict[str, int]
    extra_places: dict[str, int]
    promo_actions: dict[str, int]
    # staging (607) attribute sets
    facing_init_attrs: tuple[int, ...]  # initial facing rows
    facing_attrs: tuple[int, ...]       # counted as facing (day match)
    shelf_attrs: tuple[int, ...]        # counted as shelf (day match)
    store_attrs: tuple[int, ...]        # counted as store (no date rule)
    # master-data attributes
    obj_banner_attr: int                # 611 on outlets (dict 2) and products (dict 1)
    obj_email_attr: int                 # 633
    outlet_dict: int = 2
    product_dict: int = 1
    outlet_face_type: int = 7
    # product name tests
    listing_name_parts: tuple[str, ...] = ()   # substring match (LIKE '%x%')
    facing_name_prefixes: tuple[str, ...] = ()  # first three characters
    # filter-set type codes
    flt_agent: int = 440003
    flt_outlet: int = 440008
    flt_owner: int = 6
    flt_owner_dict: int = 2
    flt_doc_type: int = 440011
    flt_flag: int = 440200
    flt_period: int = 440001
    # column codes of the extracts: code -> column, or None for a code without one
    visit_columns: dict[int, str | None] = field(default_factory=lambda: dict(VISIT_CODES))
    face_columns: dict[int, str | None] = field(default_factory=lambda: dict(FACE_CODES))
    document_columns: dict[int, str | None] = field(default_factory=lambda: dict(DOCUMENT_CODES))
    # the original's text tests follow an unknown, often case-insensitive
    # collation; binary by default (Q10)
    names_ci: bool = False
    # quirk switches (see README "Quirks")
    extra_places_filter_on: str = "id"        # live: filter on object id (Q5)
    promo_filter_on: str = "id"
    main_places_dict: int | None = 1          # DictId test of 608 (Q6)
    extra_places_dict: int | None = 1         # DictId test of 612
    promo_dict: int | None = None             # 611 has none
    labels: ReportLabels = field(default_factory=ReportLabels)
    # address parts appended to outlets: column -> pattern (group 1 is kept).
    # The original's parser is not in its file; these patterns are ours.
    address_fields: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_ADDRESS_FIELDS))


# The codes of the original report, in the order the report
# uses them. Names are the report's column meanings.
REFERENCE_CODES = AuditCodes(
    doc_stock=613,
    doc_order_info=610,
    doc_main_places=608,
    doc_extra_places=612,
    doc_promo=611,
    doc_stock_check=607,
    doc_photo=230,
    fact_doc_types=(613, 610, 608, 612, 611),
    doc_allowlist=(611, 612, 608, 230, 610, 607, 206),
    attr_facing=620,
    attr_shelf=634,
    attr_store=635,
    attr_order_info=602,
    main_places={
        "shelf": 1000005,
        "canoe": 1000006,
        "pallet": 1000007,
        "cold_showcase": 1000008,
        "fridge": 1000009,
        "basket": 1000010,
    },
    extra_places={
        "racks": 612,
        "gondola_end": 613,
        "pallet": 614,
        "other": 615,
        "no_extra_place": 616,
    },
    promo_actions={
        "price_cut": 603,
        "promo_2plus1": 604,
        "promo_1plus1": 605,
        "bundling": 606,
    },
    facing_init_attrs=(695, 708, 694, 634, 635),
    facing_attrs=(695, 708, 694),
    shelf_attrs=(634,),
    store_attrs=(635,),
    obj_banner_attr=611,
    obj_email_attr=633,
    listing_name_parts=("Куш", "СКИТ"),
    facing_name_prefixes=("СКИ", "Куш"),
)
