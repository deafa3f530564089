"""Questions and answers from records: 43 templates as expressions, expanded in one scan.

A template has a dimension, fields that must be given, least lengths of lists, an optional further condition, and texts with slots:
{belt}, {rocks[:3]} (the first three, joined), {structs[0]}, {alt[-1]|propylitic} (with a default), {dep} (the type's label).
Texts are this library's own; ids, dimensions and conditions are fixed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import categories, join_first, truthy_field, with_any
from ..functions.text import article, short_id
from .records import populated

#: Dimensions whose templates are used, codes and their labels.
TIER_A = ("spatial_location", "spatial_model", "structural_control", "temporal_spatial")
LABELS = {
    "PORP-CUMO": "porphyry Cu-Mo",
    "PORP-CUAU": "porphyry Cu-Au",
    "IOCG": "iron oxide copper-gold (IOCG)",
    "OROG-AU": "orogenic gold",
    "VMS": "volcanogenic massive sulfide (VMS)",
    "SEDEX": "sedimentary exhalative (SEDEX)",
    "MVT": "Mississippi Valley-type (MVT)",
    "CARLIN": "Carlin-type gold",
    "EPITHERMAL": "epithermal",
    "HS-EPITH": "high-sulfidation epithermal",
    "LS-EPITH": "low-sulfidation epithermal",
    "SKARN": "skarn",
    "MAGMATIC-NI": "magmatic Ni-Cu-PGE",
    "BIF-AU": "BIF-hosted gold",
}
#: Codes of the current vocabulary and the code that labels go by.
CURRENT = {"PORPHYRY-CU-MO": "PORP-CUMO", "PORPHYRY-CU-AU": "PORP-CUAU", "EPITHERMAL-HS": "HS-EPITH", "EPITHERMAL-LS": "LS-EPITH", "NI-CU-PGE": "MAGMATIC-NI", "NI-CU": "MAGMATIC-NI"}
FLUIDS = {
    "PORP-CUMO": "fluids released by a crystallising felsic stock",
    "PORP-CUAU": "fluids released by an oxidised, sulfur-bearing magma",
    "IOCG": "hot oxidised fluids from magma and from outside",
    "OROG-AU": "fluids set free by metamorphism and led up crustal shear zones",
    "VMS": "vents on a volcanic sea floor",
    "SEDEX": "brines squeezed out of a compacting basin",
    "MVT": "cool basin brines moving through aquifers",
    "CARLIN": "deep fluids rising along steep faults",
    "EPITHERMAL": "cool fluids close to a volcanic surface",
    "HS-EPITH": "acid magmatic vapour condensing at shallow depth",
    "LS-EPITH": "nearly neutral fluids, partly rain water, rising along faults",
    "SKARN": "magmatic fluids reacting with carbonate at a contact",
    "MAGMATIC-NI": "mafic magma saturated with sulfide liquid",
    "BIF-AU": "metamorphic fluids soaking into iron-rich layers",
}
TRAPS = {
    "PORP-CUMO": "Ore fills fracture networks in the brittle roof of the stock.",
    "PORP-CUAU": "Ore fills veinlets around the top of the intrusion.",
    "IOCG": "Crustal faults tie deep sources to reactive rocks above.",
    "OROG-AU": "Ore gathers at bends, jogs and strength contrasts of shear zones.",
    "VMS": "Faults active during volcanism fix where vents open.",
    "SEDEX": "Growth faults fix where brines reach the basin floor.",
    "MVT": "Aquifer margins and fractured ground steer the brines.",
    "CARLIN": "Steep feeders that cut reactive carbonate make the best traps.",
    "HS-EPITH": "Steep fractures lead vapour up to ground water.",
    "LS-EPITH": "Dilating stretches of faults open room for veins.",
    "SKARN": "The shape of the contact and the faults across it fix the ore.",
    "MAGMATIC-NI": "Hollows and narrows of magma conduits catch dense sulfide.",
    "BIF-AU": "Fold hinges and shears open the iron formation.",
}
NAMES = {"belt": "metallogenic_belt", "tectonic": "tectonic_setting", "rocks": "host_rocks", "structs": "structural_controls", "alt": "alteration", "mins": "minerals_mentioned", "comms": "commodities", "ages": "ages_ma", "type": "deposit_type"}
SPATIAL_FIELDS = ("host_rocks", "structural_controls", "alteration", "minerals_mentioned", "metallogenic_belt", "tectonic_setting", "ages_ma", "commodities", "deposit_type")
ROCK_CLASSES = {
    "intrusive": "granite diorite gabbro monzonite syenite tonalite porphyry aplite pegmatite".split(),
    "volcanic": "andesite basalt rhyolite dacite tuff ignimbrite lava pyroclastic volcanic".split(),
    "sedimentary": "sandstone limestone shale siltstone mudstone conglomerate dolomite carbonate".split(),
    "metamorphic": "gneiss schist quartzite marble amphibolite greenstone phyllite slate meta".split(),
}
ORE_MINERALS = "chalcopyrite pyrite galena sphalerite molybdenite bornite gold silver arsenopyrite magnetite hematite chalcocite covellite enargite tennantite tetrahedrite".split()
GANGUE_MINERALS = "quartz calcite dolomite fluorite barite sericite chlorite epidote feldspar albite orthoclase".split()
REACTIVE = {
    "mafic rocks": "basalt gabbro diorite andesite mafic greenstone".split(),
    "carbonates": "limestone dolomite marble carbonate calc".split(),
    "reduced sediments": "shale black graphit carbon".split(),
}


def lookup_code(table: dict, default: Column | str) -> Column:
    pairs = [F.lit(x) for p in table.items() for x in p]
    code = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in CURRENT.items() for x in p]), F.col("deposit_type")), F.col("deposit_type"))
    found = F.when(code.isNotNull(), F.try_element_at(F.create_map(*pairs), code))
    return F.coalesce(found, F.lit(default) if isinstance(default, str) else default)


def label() -> Column:
    return lookup_code(LABELS, F.coalesce(F.nullif("deposit_type", F.lit("")), F.lit("deposit")))


def _slot(text: str) -> Column:
    m = re.fullmatch(r"(\w+)(?:\[(-?\d*)(:?)(-?\d*)\])?(?:\|(.*))?", text)
    name, a, colon, b, default = m.groups()
    if name == "dep":
        return label()
    if name == "an":
        return article(F.col(NAMES[default]))
    if name == "fluid":
        return lookup_code(FLUIDS, "hydrothermal fluids")
    if name == "trap":
        return lookup_code(TRAPS, "These structures fix where ore lies and what shape it has.")
    c = F.col(NAMES[name])
    if a is None and b is None:
        return c if name in ("belt", "tectonic", "type") else join_first(c.cast("array<string>"))
    if colon:
        start = int(a or 0)
        items = c.cast("array<string>")
        out = join_first(F.slice(items, start + 1, int(b) - start) if b else F.slice(items, F.lit(start + 1), F.greatest(F.size(items) - start, F.lit(0))))
        return F.coalesce(F.nullif(out, F.lit("")), F.lit(default)) if default else out
    k = int(a)
    found = F.try_element_at(c.cast("array<string>"), F.lit(k + 1 if k >= 0 else k))
    return F.coalesce(found, F.lit(default)) if default else F.coalesce(found, F.lit(""))


def render(template: str) -> Column:
    parts = []
    for k, piece in enumerate(re.split(r"\{([^}]*)\}", template)):
        if k % 2:
            parts.append(_slot(piece))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


@dataclass(frozen=True)
class Template:
    name: str
    dimension: str
    fields: str
    question: str
    answer: object  # text, or a function that gives a Column
    least: dict = field(default_factory=dict)
    when: object = None  # a function that gives a condition


def _long_belt() -> Column:
    return F.length("metallogenic_belt") >= 20


def _size(name: str) -> Column:
    return F.size(F.coalesce(F.col(NAMES[name]).cast("array<string>"), F.array().cast("array<string>")))


def _code_has(*parts: str) -> Column:
    return F.coalesce(F.col("deposit_type").rlike("|".join(parts)), F.lit(False))


_PORPHYRY, _OROGENIC, _EPITHERMAL = ("PORP",), ("OROG",), ("EPITH", "HS", "LS")


def _host_rocks() -> Column:
    many = F.concat(render("Ore lies in many rocks: {rocks[:8]}"), F.when(_size("rocks") > 8, F.lit(" and others")).otherwise(F.lit("")), F.lit(". Such a range speaks for structure rather than rock as the main control."))
    return F.when(_size("rocks") >= 5, many).otherwise(render("Ore lies in {rocks}. So few rocks speak for a strong control by the host."))


def _rock_classes() -> Column:
    names = categories("host_rocks", ROCK_CLASSES)
    return F.concat(F.lit("The hosts are "), F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise(F.lit("diverse")), F.lit(" rocks, "), _size("rocks").cast("string"), F.lit(" kinds in all, such as "), render("{rocks[:6]}."))


def _geometry() -> Column:
    return (
        F.when(_code_has(*_PORPHYRY), "A steep cylinder around the intrusion whose grade falls outwards, unlike tabular veins.")
        .when(_code_has(*_OROGENIC), "A line along its shear zone with plunging shoots, unlike disseminated bodies.")
        .when(_code_has(*_EPITHERMAL), "A shallow body of small height with flat rich levels where fluids boiled, unlike deep systems.")
        .when(F.col("deposit_type") == "SKARN", "Irregular lenses along a contact with carbonate, unlike veins.")
        .otherwise(render("A shape that {rocks[:2]} and {structs[:2]} made together, unlike plain veins."))
    )


def _depth() -> Column:
    depth = (
        F.when(_code_has(*_EPITHERMAL), "less than 2 km below the former surface")
        .when(_code_has(*_PORPHYRY), "1 to 5 km below the former surface")
        .when(_code_has(*_OROGENIC), "5 to 15 km down along shear zones")
        .when(F.col("deposit_type") == "SKARN", "1 to 5 km down at the contact of an intrusion")
        .when(F.col("deposit_type") == "VMS", "on or just under the sea floor")
        .otherwise("a depth that its process sets")
    )
    return F.concat(render("This {dep} in the {belt} formed at "), depth, F.lit(". How much has been worn away since decides which level of it can be seen."))


def _timing() -> Column:
    return (
        F.when(_code_has(*_PORPHYRY), render("{structs[0]} led magma into {rocks[:2]}; further fractures ({structs[1:3]|stockworks}) opened as the stock cooled and took up the ore."))
        .when(_code_has(*_OROGENIC), render("{structs[0]} moved while the rocks were metamorphosed; gold came with each slip and filled layered veins in {rocks[0]|the host rocks}."))
        .otherwise(render("In {rocks[:2]} the ore fills openings of {structs[:2]}, so both are of one age; later movement may have cut the ore."))
    )


def _ages() -> Column:
    years = F.filter(F.col("ages_ma").cast("array<double>"), lambda a: a.isNotNull())
    span = F.when(F.size(years) >= 2, F.concat(F.lit("from "), F.array_min(years).cast("string"), F.lit(" to "), F.array_max(years).cast("string"), F.lit(" Ma"))).otherwise(F.concat(F.lit("at "), F.coalesce(F.try_element_at(years, F.lit(1)).cast("string"), F.lit("?")), F.lit(" Ma")))
    return F.concat(render("Dating gives {ages[:5]} Ma, "), span, F.lit(". The ore is tied to what the region went through then."))


def _minerals() -> Column:
    ore, gangue = with_any("minerals_mentioned", ORE_MINERALS), with_any("minerals_mentioned", GANGUE_MINERALS)
    parts = F.array_compact(F.array(F.when(F.size(ore) > 0, F.concat(F.lit("ore minerals ("), join_first(ore, 6), F.lit(")"))), F.when(F.size(gangue) > 0, F.concat(F.lit("gangue ("), join_first(gangue, 6), F.lit(")")))))
    return F.concat(F.lit("There are "), F.array_join(parts, " and "), render(". That fits {fluid}; hotter sulfides are expected near the source, cooler phases away from it."))


def _reactive() -> Column:
    kinds = [F.transform(with_any("host_rocks", words), _named(kind)) for kind, words in REACTIVE.items()]
    return F.concat(*kinds)


def _named(kind: str):
    return lambda rock: F.concat(F.lit(f"{kind} ("), rock, F.lit(")"))


TEMPLATES = (
    Template("qa_location_belt", "spatial_location", "belt", "In which belt or tectonic domain does the {dep} of this paper lie?", "It lies in the {belt}.", when=_long_belt),
    Template("qa_spatial_significance", "spatial_location", "belt type", "What does the position within the {belt} tell about this {dep}?", "Its place in the {belt} allows comparison with like deposits along strike, ties the ore to the region's tectonics and points to similar places.", when=_long_belt),
    Template("qa_tectonic_context", "spatial_location", "belt tectonic", "What is the tectonic setting of the deposit, and where does it lie?", "It formed in {an|tectonic} {tectonic} setting within the {belt}."),
    Template("qa_host_rocks_spatial", "host_rock_relation", "rocks type", "How does {dep} ore relate in space to its host rocks?", _host_rocks),
    Template("qa_host_rock_classification", "host_rock_relation", "rocks", "Which classes of rock host the ore?", _rock_classes, {"rocks": 3}),
    Template("qa_hostrock_structure_interplay", "host_rock_relation", "rocks structs type", "How do rocks and structures together place {dep} ore?", "Ore in {rocks[:4]} is steered by {structs[:3]}: fractured reactive rocks met the fluids' paths there."),
    Template("qa_hostrock_alteration_contact", "host_rock_relation", "rocks alt type", "How do host rocks and alteration of this {dep} lie to each other?", "{rocks[:4]} are overprinted by {alt}; reactive rocks are altered more and further, which points towards ore."),
    Template("qa_structural_lithology_trap", "structural_control", "structs rocks type", "Where do structures and rocks meet to trap ore in this {dep}?", "Where {structs[0]} cut {rocks[:3]}: pressure, acidity and redox change there and metals drop out."),
    Template("qa_structural_regional_context", "structural_control", "structs belt", "How do the deposit's structures fit into the {belt}?", "{structs[:3]} belong to the fault pattern of the {belt} and brought fluids from regional to local scale."),
    Template("qa_mineral_alteration_spatial", "mineral_assemblage", "mins alt type", "How do minerals and alteration of this {dep} lie to each other?", "{mins[:5]} occur with {alt}; the inner alteration holds most of the ore minerals.", {"mins": 3}),
    Template("qa_mineral_structural_control", "mineral_assemblage", "mins structs", "How do structures place the minerals?", "{mins[:5]} fill openings of {structs[:3]} and thin out away from them.", {"mins": 3}),
    Template("qa_metal_structural_zoning", "temporal_spatial", "comms structs type", "How are metals zoned along the structures of this {dep}?", "{comms} change along {structs[:2]}: hotter metals near the feeders, cooler ones further off, above rich cores that may be hidden.", {"comms": 2}),
    Template("qa_age_belt_evolution", "temporal_spatial", "ages belt type", "How does the ore's age relate to the history of the {belt}?", "At {ages[:5]} Ma the {dep} takes its place in the history of the {belt} and can be compared with deposits of that age along it."),
    Template("qa_integrated_spatial_model", "spatial_model", "rocks structs mins type", "How do rocks, structures and minerals together shape this {dep} in three dimensions?", "Rocks ({rocks[:3]}) react, structures ({structs[:3]}) lead {fluid}, minerals ({mins[:4]}) record cooling outwards; grade falls away from where structures cut the rocks.", {"mins": 3}),
    Template("qa_multiscale_spatial", "spatial_model", "belt tectonic structs type", "What controls this {dep} from region to deposit?", "The {belt} ({tectonic}) sets the province, first-order structures the district, {structs[:3]} the ore itself."),
    Template("qa_proximal_distal_gradient", "spatial_model", "rocks alt mins type", "What changes from the centre of this {dep} outwards?", "At the centre {alt[0]} with {mins[:3]} and the best grades; then mixed zones; far out {alt[-1]|propylitic} and only a halo.", {"mins": 4}),
    Template("qa_exploration_vector", "exploration", "structs mins type", "What leads towards ore of this {dep}?", "Follow {structs[:2]} where {mins[0]} and {mins[1]|sulfides} increase.", {"mins": 3}),
    Template("qa_exploration_footprint", "exploration", "alt rocks type", "How large a footprint does this {dep} leave?", "{alt} in {rocks[:3]} reaches well beyond ore and can be mapped."),
    Template("qa_exploration_dispersion", "exploration", "comms structs type", "How do metals of this {dep} disperse?", "{comms} spread along {structs[:2]} and thin out across them.", {"comms": 2}),
    Template("qa_compare_geometry", "comparative", "type rocks structs", "How does the shape of this {dep} differ from that of other types?", _geometry),
    Template("qa_compare_tectonic_niche", "comparative", "type tectonic belt", "What place does this {dep} take in the tectonics of the {belt}?", "In the {tectonic} frame of the {belt} its place limits which fluids and metals it could draw on."),
    Template("qa_deposit_dimensions", "spatial_model", "structs type comms rocks", "What size and shape may this {dep} have?", "Along {structs[0]} through {rocks[:2]}, hundreds to thousands of metres long and tens to hundreds wide; {comms[:3]} gather in shoots where it opens.", {"comms": 2}),
    Template("qa_depth_of_formation", "spatial_model", "rocks type belt", "How deep did this {dep} form, and what does that mean for what is exposed?", _depth),
    Template("qa_exploration_targeting_criteria", "exploration", "rocks mins structs type", "What should one look for to find more of this {dep}?", "{rocks[:3]} cut by {structs[:3]} with {mins[:4]}.", {"mins": 4}),
    Template("qa_structural_spatial", "structural_control", "structs type", "How do structures control where ore of this {dep} lies?", "The structures are {structs}. {trap}"),
    Template("qa_structural_hierarchy", "structural_control", "structs", "In what order do structures control the ore, from region to vein?", "{structs[0]} comes first and sets the shape; {structs[1:]} open room for rich shoots.", when=lambda: _size("structs") >= 2),
    Template("qa_alteration_zoning", "alteration_zonation", "alt type", "What do the alteration zones of this {dep} tell about its shape?", "{alt} follow one another outwards: {alt[0]} where it was hottest, {alt[-1]} where it was coolest.", when=lambda: _size("alt") >= 3),
    Template("qa_mineral_zonation", "mineral_assemblage", "mins type", "What do the minerals of this {dep} tell about how and where it formed?", _minerals, {"mins": 3}),
    Template("qa_mineral_vector", "mineral_assemblage", "mins", "Which minerals point towards richer ore?", "Among {mins[:8]}, more sulfide against barren pyrite and hotter alteration minerals point inwards.", {"mins": 5}),
    Template("qa_age_spatial", "temporal_spatial", "ages type", "How old is this {dep}, and what does its age tie it to?", _ages),
    Template("qa_metal_zoning", "temporal_spatial", "comms belt type", "What do {comms} together tell about heat in this {dep}?", "{comms} dropped out in order of temperature, the hotter ones near the source; the same order can be mapped across the {belt}.", {"comms": 2}),
    Template("qa_belt_metal_endowment", "spatial_location", "belt comms type", "Which metals is the {belt} rich in, and how does this {dep} fit?", "The {belt} holds {comms} in {dep} systems; where {comms[0]} is known along it, like places may hold more.", {"comms": 2}, _long_belt),
    Template("qa_hostrock_reactivity", "host_rock_relation", "rocks type comms", "Which host rocks react most, and where would {comms[0]} be richest?", lambda: F.concat(F.lit("The most reactive are "), join_first(_reactive(), 3, "; "), render("; {comms[0]} is richest where they meet fluid paths.")), {"comms": 1}, lambda: F.size(_reactive()) > 0),
    Template("qa_structural_permeability", "structural_control", "structs mins type", "How did deformation open this {dep} to fluids?", "{structs[:3]} opened veins ({mins[0]}, {mins[1]|quartz}), crushed rock and bends of low pressure where fluids met.", {"mins": 3}),
    Template("qa_structural_timing", "structural_control", "structs type rocks", "Did structures form before, with or after the ore, and how does that shape it?", _timing),
    Template("qa_mineral_wallrock_reaction", "mineral_assemblage", "mins rocks type", "How did wall rock and fluid make the minerals of this {dep}?", "{mins[:4]} grew where fluid reacted with {rocks[:3]}.", {"mins": 4}),
    Template("qa_mineral_metal_deportment", "mineral_assemblage", "mins comms type", "Which minerals carry the metals of this {dep}?", "{comms[:4]} are carried by {mins[:5]}.", {"mins": 5, "comms": 2}),
    Template("qa_metal_migration_pathways", "temporal_spatial", "comms structs rocks type", "Along which paths did metals of this {dep} move?", "{comms[:3]} moved along {structs[:3]} and dropped out in {rocks[:3]}.", {"comms": 2}),
    Template("qa_preservation_exposure", "spatial_model", "rocks structs type belt", "What can be seen of this {dep} at today's surface?", "One level of it in the {belt}: if much is gone, roots such as {structs[0]}; if little, upper parts in {rocks[:2]} with ore perhaps below."),
    Template("qa_fluid_flow_architecture", "spatial_model", "structs alt mins type", "How did fluids flow through this {dep}?", "{structs[:2]} were the pipes, {alt} marks where it was hot, {mins[:3]} record the state at each place; flow rose in feeders and spread out above.", {"mins": 3}),
    Template("qa_exploration_concealed", "exploration", "structs rocks belt type", "Where might more of this {dep} be hidden?", "Where {structs[:2]} pass under cover through {rocks[:2]} of the {belt}."),
    Template("qa_compare_ore_shoot_controls", "comparative", "type structs mins", "How do shoots of this {dep} differ from those of other types?", "They follow {structs[:2]} and carry {mins[:3]}.", {"mins": 3}),
    Template("qa_compare_alteration_width", "comparative", "type rocks alt", "How wide is alteration of this {dep} beside that of other types?", "{alt} reaches as far as {rocks[:2]} let fluids in."),
)


def expand(df: DataFrame, templates=TEMPLATES, dimensions=TIER_A, least_fields: int | None = None) -> DataFrame:
    """(id, source, paper_id, dimension, template, deposit_type, question, answer): a row for each template that fits a record."""
    rows = df if least_fields is None else populated(df, SPATIAL_FIELDS, least_fields)
    given = {n: truthy_field(rows, n) for n in SPATIAL_FIELDS}
    made = []
    for t in templates:
        if t.dimension not in dimensions:
            continue
        ok = F.lit(True)
        for f in t.fields.split():
            ok = ok & given[NAMES[f]]
        for f, n in t.least.items():
            ok = ok & (_size(f) >= n)
        if t.when is not None:
            ok = ok & F.coalesce(t.when(), F.lit(False))
        answer = render(t.answer) if isinstance(t.answer, str) else t.answer()
        made.append(F.when(ok, F.struct(F.lit(t.dimension).alias("dimension"), F.lit(t.name).alias("template"), render(t.question).alias("question"), answer.alias("answer"))))
    out = rows.select("paper_id", "deposit_type", F.explode(F.array_compact(F.array(*made))).alias("q"))
    return out.select(F.concat(F.lit("qa_"), short_id("paper_id", "q.dimension", "q.template")).alias("id"), F.lit("template").alias("source"), "paper_id", "q.dimension", "q.template", "deposit_type", "q.question", "q.answer")


def dimension_counts(qa: DataFrame) -> DataFrame:
    return qa.groupBy("dimension").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dimension")
