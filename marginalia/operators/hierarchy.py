"""Translation families, locale representatives, event replay and public routes.

All choices of one row out of many are min/max aggregates, so a family, slug or route
holding a large share of the rows is combined map-side. The only ordered step, the
replay of titles and toggles, runs in buckets (see functions.ordered).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions.lineage import written
from ..functions.ordered import best_per_group, block_of, bounded_row_number, latest_before

MEMBER = [
    "page_id", "title", "slug", "section", "section_order", "element_type",
    "language_source", "has_body", "source_idx", "is_child",
]


def source_rank(source: str = "language_source") -> Column:
    s = F.col(source)
    return F.when(s == "explicit", 0).when(s == "automated", 1).when(s == "fallback", 2).otherwise(3)


def curated(labels: dict, locale: Column | str, plain: Column) -> Column:
    """Curated translation of a plain label, NULL without one. The table is configuration
    of fixed size and becomes one constant."""
    entries = [F.lit(x) for loc, m in labels.items() for k, v in m.items() for x in (f"{loc}/{k}", v)]
    return F.try_element_at(F.create_map(*entries), F.concat_ws("/", locale, plain))


class HierarchyPlan:
    """The publishing plan of a page catalog as a set of lazy DataFrames.

    ``docs`` needs: page_id, title, locale, section, section_order, element_type, slug,
    status, sub_items, language_source, has_body, source_idx (unique, the input order).
    """

    DOC = [
        "page_id", "title", "locale", "section", "section_order", "element_type", "slug",
        "status", "sub_items", "language_source", "has_body", "source_idx",
    ]

    def __init__(self, docs: DataFrame, include_drafts: bool = False, labels: dict | None = None):
        self.spark = docs.sparkSession
        self.include_drafts = include_drafts
        self.labels = labels or fixed.SECTION_LABELS
        docs = docs.select(*self.DOC).withColumns(
            {
                "locale": C.normalize_locale("locale"),
                "element_type": F.coalesce("element_type", F.lit("")),
                "title": F.coalesce("title", F.lit("")),
                "sub_items": F.coalesce("sub_items", F.expr("CAST(array() AS array<string>)")),
                "language_source": F.coalesce("language_source", F.lit("fallback")),
                "has_body": F.coalesce("has_body", F.lit(False)),
            }
        )
        docs = docs.withColumn("internal_title", C.is_internal_title("title", "page_id"))
        # Written once, so that texts behind the catalog are scanned once.
        self.docs = written(self._with_roles(written(docs, "docs")), "catalog")

    # -- who belongs where --------------------------------------------------------

    @staticmethod
    def _with_roles(docs: DataFrame) -> DataFrame:
        """Add the role flags every later step filters by.

        internal: the title is internal, or an internal page lists this page. listed: a
        page that is not internal lists it. foreign: one other than itself does.
        """
        flagged = docs.filter("internal_title")
        internal = (
            flagged.select("page_id")
            .unionByName(flagged.select(F.explode("sub_items").alias("page_id")))
            .distinct()
            .withColumn("internal", F.lit(True))
        )
        docs = docs.join(internal, "page_id", "left").withColumn("internal", F.coalesce("internal", F.lit(False)))
        listed = (
            docs.filter(~F.col("internal"))
            .select(F.col("page_id").alias("parent"), F.explode("sub_items").alias("page_id"))
            .groupBy("page_id")
            .agg(F.lit(True).alias("listed"), F.max(F.col("parent") != F.col("page_id")).alias("foreign"))
        )
        docs = docs.join(listed, "page_id", "left")
        return docs.withColumns({f: F.coalesce(f, F.lit(False)) for f in ("listed", "foreign")}).drop("internal_title")

    @cached_property
    def visible(self) -> DataFrame:
        return self.docs.filter(~F.col("internal"))

    @cached_property
    def parents(self) -> DataFrame:
        return self.visible.filter(F.size("sub_items") > 0)

    @cached_property
    def relations(self) -> DataFrame:
        return self.parents.select(
            F.col("page_id").alias("family_id"), F.posexplode("sub_items").alias("rel_pos", "child_id")
        )

    @cached_property
    def unclaimed(self) -> DataFrame:
        """Pages of no family, as parent or as child."""
        return self.visible.filter((F.size("sub_items") == 0) & ~F.col("listed"))

    @cached_property
    def nested_parents(self) -> DataFrame:
        return self.parents.filter("foreign")

    @cached_property
    def roots(self) -> DataFrame:
        kept = self.parents.filter(~F.col("foreign"))
        content = C.is_content("element_type")
        kept = kept.filter((content | C.is_structural("element_type")) & ~C.is_dead("status"))
        gate = ~content | C.publishable("status", self.include_drafts)
        return kept.filter(gate).withColumns({"family_is_content": content, "family_id": F.col("page_id")})

    @cached_property
    def members(self) -> DataFrame:
        """Children in relation order, then the parent itself, one row per membership."""
        head = ["family_id", "family_is_content", F.col("locale").alias("parent_locale")]
        listed = self.roots.select(*head, F.posexplode("sub_items").alias("rel_pos", "page_id"))
        child = self.visible.select(
            "page_id", "title", "slug", "locale", "section", "section_order", "element_type",
            "language_source", "has_body", "source_idx", "status",
        )
        children = listed.join(child, "page_id").filter(
            ~C.is_dead("status")
            & (~F.col("family_is_content") | C.publishable("status", self.include_drafts))
        )
        own = self.roots.select(
            *head, F.size("sub_items").alias("rel_pos"), *[c for c in child.columns]
        )
        return children.withColumn("is_child", F.lit(True)).unionByName(own.withColumn("is_child", F.lit(False)))

    @cached_property
    def standalone_structural(self) -> DataFrame:
        return self.unclaimed.filter(C.is_structural("element_type"))

    @cached_property
    def standalone_content(self) -> DataFrame:
        return self.unclaimed.filter(
            C.is_content("element_type")
            & C.publishable("status", self.include_drafts)
            & ~C.is_test_title("title")
        )

    # -- one representative per family and locale -----------------------------------

    @cached_property
    def selected(self) -> DataFrame:
        """Narrowing to children and to real bodies is a lexicographic rank.

        For the own locale of an English parent bodies come before children; in all
        other groups children come first.
        """
        english = (F.col("locale") == "en") & (F.col("parent_locale") == "en")
        child, body = (~F.col("is_child")).cast("int"), (~F.col("has_body")).cast("int")
        rank = [
            F.when(english, body).otherwise(child),
            F.when(english, child).otherwise(body),
            source_rank(),
            (F.col("element_type") == "").cast("int"),
            C.is_staging_title("title").cast("int"),
            F.coalesce("section_order", F.lit(fixed.MISSING_ORDER)),
            F.col("rel_pos"),
        ]
        best = best_per_group(
            self.members, ["family_id", "family_is_content", "parent_locale", "locale"], rank, MEMBER
        )
        return written(best, "selected")

    @cached_property
    def selected_english(self) -> DataFrame:
        en = self.selected.filter(F.col("locale") == "en")
        return en.select("family_id", F.struct(*MEMBER).alias("en"))

    @cached_property
    def families(self) -> DataFrame:
        """Canonical section, order, slug and flow order per family."""
        f = self.roots.join(self.selected_english, "family_id", "left")
        own_slug = F.coalesce(C.non_empty(C.slugify("title")), F.col("slug"))
        en_slug = F.coalesce(C.non_empty(C.slugify("en.title")), F.col("en.slug"))
        order = F.coalesce("section_order", "en.section_order", F.lit(fixed.UNCATEGORIZED_ORDER))
        f = f.select(
            "family_id",
            "family_is_content",
            F.col("locale").alias("parent_locale"),
            F.col("title").alias("parent_title"),
            F.lower("element_type").alias("parent_type"),
            F.col("source_idx").alias("parent_idx"),
            F.coalesce(C.non_empty("section"), C.non_empty("en.section"), F.lit(fixed.UNCATEGORIZED)).alias(
                "canonical_section"
            ),
            order.alias("canonical_order"),
            F.when((F.col("locale") == "en") | F.col("en").isNull(), own_slug).otherwise(en_slug).alias("canonical_slug"),
            F.coalesce("en.section_order", order).alias("flow_order"),
            F.col("en.page_id").alias("en_page_id"),
            F.col("en.has_body").alias("en_has_body"),
            F.col("en.source_idx").alias("en_idx"),
        )
        return written(f, "families")

    @cached_property
    def family_pages(self) -> DataFrame:
        chosen = self.selected.filter("family_is_content").filter(C.is_content("element_type"))
        fam = self.families.drop("family_is_content", "parent_locale")
        p = chosen.drop("family_is_content", "parent_locale").join(fam, "family_id")
        foreign = F.col("locale") != "en"
        return p.select(
            "page_id", "title", "slug", "section", "section_order", "element_type", "language_source",
            "has_body", "source_idx", "locale", "canonical_slug", "canonical_section", "canonical_order",
            F.col("flow_order").alias("event_order"),
            F.col("family_id"),
            "parent_idx",
            F.when(foreign, F.col("en_page_id")).alias("en_sibling_id"),
            F.when(foreign & ~F.col("has_body") & F.col("en_has_body"), F.col("en_page_id")).alias("en_fallback_id"),
        )

    @cached_property
    def standalone_pages(self) -> DataFrame:
        order = F.coalesce("section_order", F.lit(fixed.UNCATEGORIZED_ORDER))
        none = F.lit(None).cast("string")
        return self.standalone_content.select(
            "page_id", "title", "slug", "section", "section_order",
            F.lower("element_type").alias("element_type"), "language_source", "has_body", "source_idx", "locale",
            F.coalesce(
                C.non_empty("slug"), C.non_empty(C.slugify("title")), F.left("page_id", F.lit(8))
            ).alias("canonical_slug"),
            F.coalesce(C.non_empty("section"), F.lit(fixed.UNCATEGORIZED)).alias("canonical_section"),
            order.alias("canonical_order"),
            order.alias("event_order"),
            none.alias("family_id"),
            F.col("source_idx").alias("parent_idx"),
            none.alias("en_sibling_id"),
            none.alias("en_fallback_id"),
        )

    @cached_property
    def pages(self) -> DataFrame:
        """Content pages of the plan before replay and route deduplication."""
        return written(self.family_pages.unionByName(self.standalone_pages), "pages")

    # -- structural events and replay ---------------------------------------------------

    @cached_property
    def structural_members(self) -> DataFrame:
        """Locale titles of structural rows: (family_id, locale, member_title)."""
        grouped = self.selected.filter(~F.col("family_is_content")).select(
            "family_id", "locale", F.col("title").alias("member_title")
        )
        alone = self.standalone_structural.select(
            F.col("page_id").alias("family_id"), "locale", F.col("title").alias("member_title")
        )
        return grouped.unionByName(alone)

    @cached_property
    def structural(self) -> DataFrame:
        order = F.coalesce("section_order", F.lit(fixed.UNCATEGORIZED_ORDER))
        grouped = self.families.filter(~F.col("family_is_content")).select(
            "family_id", "parent_title", "parent_type", "canonical_section", "flow_order",
            F.coalesce("en_idx", "parent_idx").alias("event_idx"),
            F.lit(False).alias("alone"), "parent_idx",
        )
        alone = self.standalone_structural.select(
            F.col("page_id").alias("family_id"),
            F.col("title").alias("parent_title"),
            F.lower("element_type").alias("parent_type"),
            F.coalesce(C.non_empty("section"), F.lit(fixed.UNCATEGORIZED)).alias("canonical_section"),
            order.alias("flow_order"),
            F.col("source_idx").alias("event_idx"),
            F.lit(True).alias("alone"), F.col("source_idx").alias("parent_idx"),
        )
        return grouped.unionByName(alone)

    @cached_property
    def section_locales(self) -> DataFrame:
        """Locales present in each section, from pages and from structural members."""
        from_pages = self.pages.select("canonical_section", "locale")
        from_rows = self.structural.select("family_id", "canonical_section").join(
            self.structural_members.select("family_id", "locale"), "family_id"
        )
        return from_pages.unionByName(from_rows.drop("family_id")).distinct()

    @cached_property
    def structural_events(self) -> DataFrame:
        """Every structural row once per locale of its section, with that locale's title."""
        fallback = F.concat(F.lit("toggle-"), F.left("family_id", F.lit(8)))
        rows = self.structural.join(self.section_locales, "canonical_section")
        rows = rows.join(self.structural_members, ["family_id", "locale"], "left")
        folder = F.coalesce(C.non_empty(C.slugify("parent_title")), fallback)
        return rows.withColumn("toggle_dir", F.when(F.col("parent_type") == "toggle", folder))

    @cached_property
    def events(self) -> DataFrame:
        """Structural rows and pages of one (section, locale) in replay order."""
        rows = self.structural_events.select(
            "canonical_section", "locale", F.col("parent_type").alias("event"),
            F.col("flow_order").alias("event_order"), "event_idx",
            "family_id", "member_title", "toggle_dir", "parent_title",
        )
        pages = self.pages.select(
            "canonical_section", "locale", F.lit("page").alias("event"), "event_order",
            F.col("source_idx").alias("event_idx"),
        ).withColumns(
            {
                "family_id": F.lit(None).cast("string"),
                "member_title": F.lit(None).cast("string"),
                "toggle_dir": F.lit(None).cast("string"),
                "parent_title": F.lit(None).cast("string"),
            }
        )
        return rows.unionByName(pages)

    @cached_property
    def replay(self) -> DataFrame:
        """A title names the next page or toggle only; a toggle stays open until the
        next title or toggle."""
        seen = latest_before(
            self.events,
            ["canonical_section", "locale"],
            [F.col("event_order"), block_of("event_idx")],
            ["event_order", "event_idx"],
            {
                "previous": (F.struct("event", "member_title"), F.lit(True)),
                "opened": (F.struct("event", "toggle_dir"), F.col("event") != "page"),
            },
        )
        seen = seen.select(
            "canonical_section", "locale", "event", "event_order", "event_idx", "family_id",
            "member_title", "toggle_dir", "parent_title",
            F.when(F.col("previous.event") == "title", F.col("previous.member_title")).alias("heading"),
            F.when(F.col("event") == "page", F.col("opened.toggle_dir")).alias("open_toggle"),
        )
        return written(seen, "replay")

    @cached_property
    def replayed_pages(self) -> DataFrame:
        placed = self.replay.filter(F.col("event") == "page").select(
            F.col("event_idx").alias("source_idx"), "locale", "canonical_section", "heading",
            F.col("open_toggle").alias("toggle_dir"),
        )
        return self.pages.join(placed, ["source_idx", "locale", "canonical_section"])

    # -- public routes --------------------------------------------------------------------

    @cached_property
    def routed_pages(self) -> DataFrame:
        folder = F.when(F.col("canonical_section") == fixed.UNCATEGORIZED, "").otherwise(
            C.section_dir("canonical_section")
        )
        return self.replayed_pages.withColumns(
            {"route_section": folder, "route_toggle": F.coalesce("toggle_dir", F.lit(""))}
        )

    def _route_rank(self) -> list[Column]:
        has_body = F.col("has_body")
        return [
            (~has_body).cast("int"),
            F.when(has_body, 0).otherwise(F.col("en_fallback_id").isNull().cast("int")),
            source_rank(),
            (F.col("element_type") == "").cast("int"),
            C.is_staging_title("title").cast("int"),
            F.col("canonical_order"),
            F.col("source_idx"),
        ]

    ROUTE = ["locale", "route_section", "route_toggle", "canonical_slug"]

    @cached_property
    def routes(self) -> DataFrame:
        """One page per public route. A winner without heading takes the heading of the
        best ranked loser that has one."""
        rank = F.struct(*self._route_rank())
        keep = [
            "page_id", "title", "canonical_section", "canonical_order", "heading", "element_type",
            "language_source", "has_body", "source_idx", "family_id", "parent_idx", "slug",
            "section_order", "en_sibling_id", "en_fallback_id",
        ]
        has_heading = C.non_empty("heading").isNotNull()
        best = self.routed_pages.groupBy(*self.ROUTE).agg(
            F.min_by(F.struct(*keep), rank).alias("w"),
            F.min_by("heading", F.when(has_heading, rank)).alias("any_heading"),
            F.count(F.lit(1)).alias("candidates"),
        )
        best = best.select(
            *self.ROUTE,
            *[F.col(f"w.{k}").alias(k) for k in keep if k != "heading"],
            F.coalesce(C.non_empty("w.heading"), F.col("any_heading")).alias("heading"),
            "candidates",
        )
        return written(best, "routes")

    @cached_property
    def dropped_pages(self) -> DataFrame:
        """Losers of contested routes, one row each, with their winner."""
        contested = self.routes.filter("candidates > 1").select(*self.ROUTE, F.col("page_id").alias("winner_id"))
        losers = self.routed_pages.select(*self.ROUTE, "page_id")
        return losers.join(contested, self.ROUTE).filter(F.col("page_id") != F.col("winner_id"))

    # -- categories ------------------------------------------------------------------------

    @cached_property
    def section_positions(self) -> DataFrame:
        """Sections numbered by numeric prefix, equal ones by first appearance: structural
        rows before pages, families before standalone rows, then the input index."""
        seen = self.structural.join(self.structural_members.select("family_id").distinct(), "family_id", "left_semi").select(
            "canonical_section", F.struct(F.lit(0).alias("kind"), "alone", F.col("parent_idx").alias("idx")).alias("at")
        )
        pages = self.pages.select(
            "canonical_section", F.struct(F.lit(1).alias("kind"), F.col("family_id").isNull().alias("alone"), F.col("parent_idx").alias("idx")).alias("at")
        )
        sections = seen.unionByName(pages).groupBy("canonical_section").agg(F.min("at").alias("at"))
        ranked = sections.select(
            "canonical_section", C.section_rank("canonical_section").alias("rank"), F.lit(0).alias("__all"), "at.kind", "at.alone", "at.idx"
        )
        out = bounded_row_number(
            ranked, ["__all"], [F.col("rank"), F.col("kind"), F.col("alone"), block_of("idx")],
            ["rank", "kind", "alone", "idx", "canonical_section"], "position",
        )
        return out.select("canonical_section", "rank", F.col("position").cast("int").alias("position"))

    @cached_property
    def section_categories(self) -> DataFrame:
        """Label per (section, locale): curated, else another section name used by the
        first page of that locale, else the plain name."""
        other = (
            self.pages.filter(C.non_empty("section").isNotNull() & (F.col("section") != F.col("canonical_section")))
            .groupBy("canonical_section", "locale")
            .agg(F.min_by("section", F.struct(F.col("family_id").isNull(), "parent_idx", "source_idx")).alias("other"))
        )
        cats = self.section_locales.join(other, ["canonical_section", "locale"], "left")
        plain, other_plain = C.section_label("canonical_section"), C.section_label("other")
        label = F.coalesce(
            curated(self.labels, "locale", plain), curated(self.labels, "locale", other_plain), other_plain, plain
        )
        cats = cats.join(self.section_positions, "canonical_section")
        folder = C.section_dir("canonical_section")
        keyed = cats.select("locale", folder.alias("section_dir"), label.alias("label"), "position", "canonical_section")
        # Two names with one folder share a category: the first name labels it, the last places it.
        first = F.struct("position", "canonical_section")
        cats = keyed.groupBy("locale", "section_dir").agg(
            F.min_by("label", first).alias("label"),
            F.max("position").alias("position"),
            F.min_by("canonical_section", first).alias("canonical_section"),
        )
        return cats

    @cached_property
    def toggle_categories(self) -> DataFrame:
        """One category per toggle row and locale, empty toggles included."""
        t = self.replay.filter(F.col("event") == "toggle")
        section = curated(self.labels, "locale", C.section_label("canonical_section"))
        title = curated(self.labels, "locale", C.section_label("parent_title"))
        cut = F.trim("member_title").rlike(r"(…|\.\.\.)$")
        label = (
            F.when(F.col("member_title").isNull(), F.coalesce(title, C.section_label("parent_title")))
            .when(cut, F.coalesce(section, C.section_label("member_title")))
            .otherwise(F.col("member_title"))
        )
        folder = C.section_dir("canonical_section")
        return t.select(
            "locale", folder.alias("section_dir"), "toggle_dir", label.alias("label"),
            F.col("event_order").alias("position"), "heading", "event_idx",
            F.concat_ws("/", folder, "toggle_dir").alias("key"),
        )

    @cached_property
    def filled_toggles(self) -> DataFrame:
        used = self.routes.filter(F.col("route_toggle") != "").select(
            "locale", C.section_dir("canonical_section").alias("section_dir"), F.col("route_toggle").alias("toggle_dir")
        )
        filled = self.toggle_categories.join(used.distinct(), ["locale", "section_dir", "toggle_dir"], "left_semi")
        return filled

    @cached_property
    def categories(self) -> DataFrame:
        sections = self.section_categories.select(
            "locale", "section_dir", F.lit("").alias("toggle_dir"), "label", "position",
            F.lit(None).cast("string").alias("heading"), F.lit(-1).cast("bigint").alias("event_idx"),
            F.col("section_dir").alias("key"),
        )
        return sections.unionByName(self.filled_toggles)

    # -- reports -----------------------------------------------------------------------------

    @cached_property
    def missing_translations(self) -> DataFrame:
        has = lambda loc: F.max(F.col("locale") == loc)
        per_family = self.selected.filter("family_is_content").groupBy("family_id").agg(
            has("es").alias("es"), has("pt").alias("pt")
        )
        absent = F.concat_ws(", ", F.when(~F.col("es"), "ES"), F.when(~F.col("pt"), "PT"))
        return per_family.withColumn("missing", absent).filter("missing <> ''").select("family_id", "missing")

    @cached_property
    def missing_language(self) -> DataFrame:
        return self.selected.filter(
            F.col("family_is_content") & (F.col("language_source") == "fallback") & (F.col("locale") != "en")
        ).select("page_id", "family_id", "locale", "title")

    @cached_property
    def diagnostics(self) -> DataFrame:
        """All findings of a run; a contested route yields one row per dropped page."""
        def rows(df: DataFrame, category: str, page: str, detail: Column) -> DataFrame:
            return df.select(
                F.lit("warn").alias("severity"), F.lit(category).alias("category"),
                F.col(page).alias("page_id"), detail.alias("detail"),
            )

        nested = rows(self.nested_parents, "nested-family-skipped", "page_id", F.lit("listed under another page"))
        contested = rows(self.dropped_pages, "duplicate-public-route", "winner_id", F.concat(F.lit("dropped: "), "page_id"))
        absent = rows(self.missing_translations, "missing-translation-children", "family_id",
                      F.concat(F.lit("Missing locale(s): "), "missing"))
        language = rows(self.missing_language, "missing-language", "page_id", F.concat(F.lit("locale defaults to "), "locale"))
        return nested.unionByName(contested).unionByName(absent).unionByName(language)

    @cached_property
    def route_aliases(self) -> DataFrame:
        """Other keys that lead to a family's slug: the members' own and title slugs,
        the dashless ids of selected members."""
        fam = self.families.filter("family_is_content").select("family_id", "canonical_slug")
        slug, title_slug = F.col("m_slug"), F.col("m_title_slug")
        everyone = self.relations.select("family_id", F.col("child_id").alias("page_id")).unionByName(
            self.roots.select("family_id", "page_id")
        )
        named = self.docs.select("page_id", F.col("slug").alias("m_slug"), C.slugify("title").alias("m_title_slug"))
        # A member counts when the family has a selected page other than the member itself.
        chosen = self.selected.filter("family_is_content").groupBy("family_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("page_id").alias("only_id")
        )
        others = everyone.distinct().join(named, "page_id").join(fam, "family_id").join(chosen, "family_id")
        others = others.filter((F.col("n") > 1) | (F.col("only_id") != F.col("page_id")))
        keys = F.array(
            F.when((slug != "") & (slug != F.col("canonical_slug")), C.slugify(slug)),
            F.when((title_slug != "") & (title_slug != F.col("canonical_slug")) & ~title_slug.eqNullSafe(slug), title_slug),
        )
        by_name = others.select("canonical_slug", F.explode(keys).alias("alias_key"), "page_id").filter("alias_key IS NOT NULL")
        by_id = self.selected.filter("family_is_content").join(fam, "family_id").select(
            "canonical_slug", C.undashed("page_id").alias("alias_key"), "page_id"
        )
        alone = self.standalone_pages
        alone_id = alone.select("canonical_slug", C.undashed("page_id").alias("alias_key"), "page_id")
        alone_slug = alone.filter(~F.col("slug").eqNullSafe(F.col("canonical_slug"))).select(
            "canonical_slug", C.slugify("slug").alias("alias_key"), "page_id"
        )
        return by_name.unionByName(by_id).unionByName(alone_id).unionByName(alone_slug).distinct()

    @cached_property
    def published_slugs(self) -> DataFrame:
        """page_id to the slug it is reachable under: own page first, then an alias."""
        own = self.routes.select("page_id", "canonical_slug", F.lit(0).alias("pass"))
        alias = self.route_aliases.select("page_id", "canonical_slug", F.lit(1).alias("pass"))
        best = best_per_group(
            own.unionByName(alias), ["page_id"], [F.col("pass"), F.col("canonical_slug")], ["canonical_slug"]
        )
        return written(best, "published")

    # -- navigation ------------------------------------------------------------------------------

    @cached_property
    def nav_edges(self) -> DataFrame:
        """Navigation tree per locale as parent/child edges with positions.

        Sections hang under the locale root, toggles and direct pages under their
        section, toggle pages under the toggle. Toggles and pages of the root section
        hang directly under the locale, after all sections.
        """
        root = fixed.UNCATEGORIZED
        section_dir = C.section_dir("canonical_section")
        pages = self.routes.withColumn("section_dir", section_dir)
        first_toggle = self.filled_toggles.groupBy("locale", "section_dir", "toggle_dir").agg(
            F.min_by(F.struct("label", "position", "key", "heading"), F.struct("position", "event_idx")).alias("t")
        )
        sections = self.section_categories.filter(F.col("canonical_section") != root).select(
            "locale", F.lit("").alias("parent_key"), F.col("section_dir").alias("node_key"),
            F.lit("section").alias("kind"), "label", F.col("position").alias("ord"), F.lit(False).alias("alone"), F.lit(0).cast("bigint").alias("tie"),
        )
        root_dir = C.section_dir(F.lit(root))
        under = F.when(F.col("section_dir") == root_dir, "").otherwise(F.col("section_dir"))
        toggles = first_toggle.select(
            "locale", under.alias("parent_key"), F.concat_ws("/", "section_dir", "toggle_dir").alias("node_key"),
            F.lit("toggle").alias("kind"), "t.label", F.col("t.position").alias("ord"), F.lit(False).alias("alone"), F.lit(-1).cast("bigint").alias("tie"),
        )
        leaf = pages.select(
            "locale",
            F.when(F.col("route_toggle") != "", F.concat_ws("/", "section_dir", "route_toggle")).otherwise(under).alias("parent_key"),
            C.route_path("canonical_section", "route_toggle", "canonical_slug").alias("node_key"),
            F.lit("page").alias("kind"), F.col("title").alias("label"),
            # Pages of equal order stand as in the plan: those of families in the order of their parents, then standalone ones.
            F.col("canonical_order").alias("ord"), F.col("family_id").isNull().alias("alone"), F.col("parent_idx").alias("tie"),
        )
        edges = sections.unionByName(toggles).unionByName(leaf)
        kind_rank = F.when(F.col("kind") == "section", 0).when(F.col("kind") == "toggle", 1).otherwise(2)
        last = (F.col("parent_key") == "") & (F.col("kind") != "section")
        edges = edges.withColumns({"rank": kind_rank, "last": last.cast("int")})
        placed = bounded_row_number(
            edges, ["locale", "parent_key"], [F.col("last"), F.col("ord"), F.col("rank"), F.col("alone"), block_of("tie")],
            ["last", "ord", "rank", "alone", "tie", "node_key"], "position",
        )
        return placed.select("locale", "parent_key", "node_key", "kind", "label", F.col("position").cast("bigint").alias("position"))


def toc_order(docs: DataFrame) -> DataFrame:
    """Table-of-contents order with a unique tail key; a range-partitioned sort."""
    order = F.coalesce("section_order", F.lit(fixed.UNCATEGORIZED_ORDER))
    return docs.withColumn("toc_order", order).orderBy("toc_order", "source_idx", "page_id")


def section_order_min(docs: DataFrame) -> DataFrame:
    """Active pages placed under sections that are ordered by their smallest page order."""
    active = docs.filter((F.col("status") == "active") & C.non_empty("section").isNotNull())
    active = active.withColumn("ord", F.coalesce("section_order", F.lit(999)))
    sections = active.groupBy("section").agg(F.min("ord").alias("section_min"))
    placed = bounded_row_number(
        active, ["section"], [F.col("ord"), block_of("source_idx")], ["ord", "source_idx"], "position"
    )
    return placed.join(sections, "section").select("section", "section_min", "page_id", "position")


def fallback_positions(docs: DataFrame) -> DataFrame:
    """Rows without an order are numbered after the largest order of their section."""
    keyed = docs.withColumn("section_key", F.coalesce("section", F.lit("")))
    top = keyed.groupBy("section_key").agg(F.greatest(F.lit(0), F.coalesce(F.max("section_order"), F.lit(0))).alias("top"))
    unplaced = bounded_row_number(
        keyed.filter("section_order IS NULL"), ["section_key"], [block_of("source_idx")], ["source_idx"], "nth"
    )
    # One row per section on the right; AQE splits an oversized section on the left.
    filled = unplaced.join(top, "section_key").withColumn("section_order", (F.col("top") + F.col("nth")).cast("int"))
    placed = keyed.filter("section_order IS NOT NULL")
    cols = ["page_id", "section", "section_order"]
    return placed.select(*cols).unionByName(filled.select(*cols))


def unique_slugs(docs: DataFrame) -> DataFrame:
    """The first holder keeps a slug, later holders get eight id characters appended."""
    based = docs.select("page_id", "source_idx", C.slugify("title").alias("base"))
    first = based.groupBy("base").agg(F.min("source_idx").alias("first_idx"))
    suffixed = F.concat_ws("-", "base", F.left(C.undashed("page_id"), F.lit(8)))
    own = F.col("source_idx") == F.col("first_idx")
    # concat_ws keeps the dash of an empty base, as the stored slugs do.
    return based.join(first, "base").select("page_id", "base", F.when(own, F.col("base")).otherwise(suffixed).alias("slug"))


KEY_SLICES = 64  # over which message keys are dealt to meet the locales


def translation_messages(plan: HierarchyPlan) -> DataFrame:
    """Message keys per non-English locale. English categories define the keys; a locale
    without a label of its own shows the English one."""
    cats = plan.categories
    # Of several toggles in one slot the last one in replay order labels it.
    slots = best_per_group(
        cats,
        ["locale", "section_dir", "toggle_dir"],
        [-F.col("position"), -F.col("event_idx")],
        ["label", "key"],
    )
    toggles_in_use = (
        plan.routes.filter((F.col("locale") == "en") & (F.col("route_toggle") != ""))
        .select(F.concat_ws("/", C.section_dir("canonical_section"), "route_toggle").alias("key"))
        .distinct()
    )
    english = slots.filter(F.col("locale") == "en").drop("locale").withColumnRenamed("label", "en_label")
    root_dir = C.section_dir(F.lit(fixed.UNCATEGORIZED))
    sections = english.filter((F.col("toggle_dir") == "") & (F.col("section_dir") != root_dir))
    toggles = english.filter("toggle_dir <> ''").join(toggles_in_use, "key", "left_semi")
    keys = sections.unionByName(toggles.select(*sections.columns))
    # Each key once per locale: keys are dealt to slices, and every locale has a row in each slice.
    locales = cats.filter(F.col("locale") != "en").select("locale").distinct()
    sliced = locales.select("locale", F.explode(F.sequence(F.lit(0), F.lit(KEY_SLICES - 1))).alias("__slice"))
    own_slice = F.pmod(F.xxhash64("key"), F.lit(KEY_SLICES)).cast("int")
    wanted = keys.withColumn("__slice", own_slice).join(sliced, "__slice").drop("__slice")
    own = slots.select("locale", "section_dir", "toggle_dir", "label")
    labelled = wanted.join(own, ["locale", "section_dir", "toggle_dir"], "left")
    key = F.concat(F.lit("sidebar.docsSidebar.category."), "key")
    text = F.coalesce("label", "en_label")
    both = F.array(key, F.concat(key, F.lit(".link.generated-index.title")))
    rows = labelled.select("locale", F.explode(both).alias("message_key"), text.alias("message"))
    version = locales.select(
        "locale", F.lit("version.label").alias("message_key"), F.lit("Latest").alias("message")
    )
    return rows.unionByName(version)


def stale_locales(published: DataFrame, current: DataFrame) -> DataFrame:
    """Locales published earlier that have no navigation any more."""
    return published.select("locale").distinct().join(current.select("locale").distinct(), "locale", "left_anti")
