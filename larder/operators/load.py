"""Staged recipes to normalised tables: cleaning, checks, deduplication, dictionaries, bridge rows.

Cleaning is narrow (array expressions, no shuffle).  Deduplication first reduces the batch to one row per
title with a map-side combined minimum, decides on those rows, and joins decisions back on the unique
staging path, so a title repeated in a third of the batch does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import lexicon, schemas
from larder.functions.amounts import clean_name, minutes, parse_amount, total_minutes
from larder.functions.identity import dense_ids, recipe_uuid
from larder.functions.text import contains_any, let, strip, word_count
from larder.functions.staging import once
from larder.operators.skew import hot_key_join


# --- cleaning -------------------------------------------------------------------------------------
def valid_staged() -> Column:
    """Whether a staged record fulfils its schema: required fields and at least one line and step."""
    lines = F.forall("ingredients", lambda i: i["item"].isNotNull() & i["amount"].isNotNull())
    steps = F.forall(
        "instructions",
        lambda s: s["step"].isNotNull() & s["title"].isNotNull() & s["description"].isNotNull(),
    )
    return F.coalesce(
        F.col("title").isNotNull() & (F.size("ingredients") >= 1) & (F.size("instructions") >= 1) & lines & steps,
        F.lit(False),
    )


def _without_null_tokens(c: str) -> Column:
    return F.when(~F.col(c).isin(lexicon.NULL_TOKENS), F.col(c))


def _time_text(c: str) -> Column:
    text = _without_null_tokens(c)
    # two words are no number, and a cast that fails raises an error inside
    number = F.when(~text.rlike(r"[^\x00-\x20][\x00-\x20]+[^\x00-\x20]"), text).try_cast("double")
    return F.when(number.isNotNull(), F.concat(number.cast("bigint").cast("string"), F.lit(" minutes"))).otherwise(text)


def _difficulty(c: str) -> Column:
    value = F.lower(strip(_without_null_tokens(c)))
    return F.when(value.isin(lexicon.DIFFICULTIES), value)


def _meal_type(c: str) -> Column:
    value = F.lower(strip(_without_null_tokens(c)))
    aliases = F.create_map(*[F.lit(x) for kv in lexicon.MEAL_TYPE_ALIASES.items() for x in kv])
    return F.when(value.isin(lexicon.MEAL_TYPES), value).otherwise(F.try_element_at(aliases, value))


def clean_fields(staged: DataFrame) -> DataFrame:
    """Null tokens, time texts, difficulty and meal type."""
    return staged.withColumns(
        {
            **{c: _time_text(c) for c in ("prepTime", "cookTime", "chillTime")},
            **{c: _without_null_tokens(c) for c in ("panSize", "cuisine")},
            "difficulty": _difficulty("difficulty"),
            "mealType": _meal_type("mealType"),
        }
    )


def instruction_texts(instructions: str = "instructions") -> Column:
    """Steps as plain strings, with their title unless it is just `Step n`."""
    return F.transform(
        instructions,
        lambda s: F.when(
            (s["title"] != "") & (s["title"] != F.concat(F.lit("Step "), s["step"].cast("string"))),
            F.concat(s["title"], F.lit(": "), s["description"]),
        ).otherwise(s["description"]),
    )


def explode_blobs(ingredients: str = "ingredients") -> Column:
    """Items that hold a whole list become one ingredient per line or bullet."""

    def pieces(i: Column) -> Column:
        parts = F.filter(F.transform(F.split(i["item"], "[\n・]"), strip), lambda p: F.length(p) > 2)
        return F.transform(
            parts, lambda p: F.struct(p.alias("item"), i["amount"].alias("amount"), i["notes"].alias("notes"))
        )

    return F.flatten(
        F.transform(
            ingredients,
            lambda i: F.when(i["item"].rlike("[\n・]"), pieces(i)).otherwise(
                F.array(F.struct(i["item"].alias("item"), i["amount"].alias("amount"), i["notes"].alias("notes")))
            ),
        )
    )


def skip_reason(item: Column) -> Column:
    """Why an item is not an ingredient; null for those that are kept.  First rule that holds wins."""

    def rules(bare: Column, lower: Column) -> Column:
        sentence = bare.endswith(".") & (word_count(item) > 5) & contains_any(lower, lexicon.LOAD_SENTENCE_VERBS)
        return (
            F.when(contains_any(lower, lexicon.LOAD_SKIP_WORDS), "instruction or header")
            .when(F.lower(bare).isin(lexicon.LOAD_NOTES), "note")
            .when((F.length(bare) < 3) & ~bare.rlike(r"^\d+$"), "too short")
            .when(sentence, "sentence")
            .when(F.btrim(item, F.lit("*[]()- \n\t")) == "", "formatting")
        )

    return let(F.lower(item), lambda lower: let(strip(item), lambda bare: rules(bare, lower)))


def check_lines(ingredients: str = "ingredients") -> Column:
    """Array of items with skip reason; the order index counts skipped items too."""
    return F.transform(
        explode_blobs(ingredients),
        lambda i, index: F.struct(
            (index + 1).alias("order_index"),
            i["item"].alias("item"),
            i["amount"].alias("amount"),
            i["notes"].alias("notes"),
            skip_reason(i["item"]).alias("reason"),
        ),
    )


def prepare_lines(checked: str = "checked") -> Column:
    """The checked lines with clean name, parsed amount and notes."""
    return F.transform(
        checked,
        lambda i: F.struct(
            i["order_index"].alias("order_index"),
            i["item"].alias("item"),
            i["reason"].alias("reason"),
            F.when(i["reason"].isNull(), clean_name(i["item"])).alias("name"),
            parse_amount(i["amount"]).alias("parsed"),
            F.when(i["notes"] != "", i["notes"]).alias("notes"),
        ),
    )


def clean_staged(staged: DataFrame) -> DataFrame:
    """Staged records as load candidates: recipe columns, prepared lines and the first problem found."""
    prepared = once(clean_fields(staged), checked=F.when(valid_staged(), check_lines())).withColumns(
        {
            "n_total": F.coalesce(F.size("checked"), F.lit(0)),
            "n_valid": F.coalesce(F.size(F.filter("checked", lambda x: x["reason"].isNull())), F.lit(0)),
        }
    )
    too_few = F.format_string(
        "too few valid ingredients (%d valid, %d skipped of %d)",
        F.col("n_valid"), F.col("n_total") - F.col("n_valid"), F.col("n_total"),
    )
    prep, cook = minutes(F.col("prepTime")), minutes(F.col("cookTime"))
    return prepared.select(
        "path",
        F.coalesce(F.col("uuid"), recipe_uuid(F.coalesce("title", F.lit("")))).alias("uuid"),
        F.when(F.col("title") == "", lexicon.UNTITLED).otherwise(F.col("title")).alias("title"),
        F.when(F.col("description") != "", F.col("description")).alias("description"),
        instruction_texts().alias("instructions"),
        prep.alias("prep_time_minutes"),
        cook.alias("cook_time_minutes"),
        total_minutes(prep, cook).alias("total_time_minutes"),
        "difficulty",
        F.col("cuisine").alias("cuisine_type"),
        F.col("mealType").alias("meal_type"),
        F.col("dietaryTags").alias("dietary_tags"),
        prepare_lines().alias("lines"),
        "n_total",
        "n_valid",
        F.when(F.col("checked").isNull(), "record does not fulfil the schema")
        .when(F.col("n_valid") < 2, too_few)
        .when(strip(F.col("title")) == "", "recipe title is blank")
        .alias("problem"),
    )


# --- deduplication ----------------------------------------------------------------------------------
def decide_titles(
    candidates: DataFrame, stored: DataFrame, cut: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """One row per title of the batch: which path loads it, under which id, and its state.

    The first path of a title is its candidate.  Stored titles are `exists`; a uuid that is stored already
    or belongs to an earlier candidate is `duplicate_uuid`; the others are `loaded` with new ids.  `cut` may
    materialise the first paths, which are read several times.
    """
    first = cut(
        candidates.where(F.col("problem").isNull())
        .groupBy("title")
        .agg(F.min(F.struct("path", "uuid")).alias("f"))
        .select("title", F.col("f.path").alias("first_path"), F.col("f.uuid").alias("uuid"))
    )
    known = first.join(stored.select("title", F.col("id").alias("stored_id")), "title", "left")
    fresh = known.where(F.col("stored_id").isNull())
    winners = (
        fresh.groupBy("uuid")
        .agg(F.min("first_path").alias("first_path"))
        .join(stored.select("uuid"), "uuid", "left_anti")
    )
    accepted = fresh.drop("stored_id").join(winners.select("first_path"), "first_path", "left_semi")
    top = stored.select(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    numbered = dense_ids(accepted, "title", top, "new_id").select("first_path", "new_id")
    return known.join(numbered, "first_path", "left").select(
        "title",
        "first_path",
        F.coalesce("stored_id", "new_id").alias("recipe_id"),
        F.when(F.col("stored_id").isNotNull(), "exists")
        .when(F.col("new_id").isNotNull(), "loaded")
        .otherwise("duplicate_uuid")
        .alias("state"),
    )


def load_status(candidates: DataFrame, decided: DataFrame) -> DataFrame:
    """One status row per staged record: success, recipe id, already-exists flag, error."""
    rows = candidates.select("path", "uuid", "title", "problem", "n_valid", "n_total")
    joined = hot_key_join(rows, decided, "title")
    failed = F.col("problem").isNotNull() | (F.col("state") == "duplicate_uuid")
    loaded = (F.col("state") == "loaded") & (F.col("first_path") == F.col("path"))
    return joined.select(
        "path",
        "title",
        "uuid",
        F.when(failed, "failed").when(loaded, "loaded").otherwise("exists").alias("status"),
        F.when(~failed, F.col("recipe_id")).alias("recipe_id"),
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("state") == "duplicate_uuid", "recipe uuid is already used by another title")
        .alias("error"),
    )


# --- dictionaries and rows ----------------------------------------------------------------------------
def new_names(stored: DataFrame, wanted: DataFrame, now: Column, extra: dict[str, Column]) -> DataFrame:
    """A dictionary row for every wanted name that is not blank and not stored yet."""
    missing = wanted.where(strip(F.col("name")) != "").dropDuplicates(["name"]).join(stored, "name", "left_anti")
    top = stored.select(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    return dense_ids(missing, "name", top).select(
        "id", "name", *[c.alias(n) for n, c in extra.items()], now.alias("created_at"), now.alias("updated_at")
    )


def kept_lines(rows: DataFrame) -> DataFrame:
    """The valid lines of loaded recipes (id, lines), one row each."""
    return (
        rows.select(F.col("id").alias("recipe_id"), F.explode("lines").alias("l"))
        .where(F.col("l.reason").isNull())
        .select(
            "recipe_id", "l.name", F.col("l.parsed.amount").cast("decimal(10,3)").alias("amount"),
            F.col("l.parsed.unit").alias("unit"), F.col("l.parsed.unit_type").alias("unit_type"),
            "l.notes", "l.order_index",
        )
    )


def link_lines(
    kept: DataFrame, ingredients: DataFrame, measurements: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows missing in both dictionaries, and the lines as bridge rows with their ids."""
    none = F.lit(None).cast("string")
    new_ingredients = new_names(ingredients, kept.select("name"), now, {"category": none, "description": none})
    abbreviations = F.create_map(*[F.lit(x) for u in lexicon.UNITS for x in (u[0], u[1])])
    new_measurements = new_names(
        measurements,
        kept.where(F.col("unit").isNotNull()).select(F.col("unit").alias("name"), "unit_type"),
        now,
        {"abbreviation": F.try_element_at(abbreviations, F.col("name")), "unit_type": F.col("unit_type")},
    )
    # parsed units are canonical names, so at most len(UNITS) dictionary rows can match
    unit_ids = F.broadcast(
        measurements.unionByName(new_measurements).where(F.col("name").isin([u[0] for u in lexicon.UNITS])).select(
            F.col("name").alias("unit"), F.col("id").alias("measurement_id")
        )
    )
    ids = ingredients.unionByName(new_ingredients).select("name", F.col("id").alias("ingredient_id"))
    rows = hot_key_join(kept, ids, "name", "inner").join(unit_ids, "unit", "left").select(
        "recipe_id", "ingredient_id", "measurement_id", "amount", "notes", "order_index", now.alias("created_at")
    )
    return new_ingredients, new_measurements, rows


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty tables with the seed measurements."""
    seed = [(i + 1, *m) for i, m in enumerate(lexicon.SEED_MEASUREMENTS)]
    never = F.lit(None).cast("timestamp")
    return {
        "recipes": spark.createDataFrame([], schemas.RECIPES),
        "ingredients": spark.createDataFrame([], schemas.INGREDIENTS),
        "measurements": spark.createDataFrame(
            seed, "id bigint, name string, abbreviation string, unit_type string"
        ).withColumns({"created_at": never, "updated_at": never}),
        "recipe_ingredients": spark.createDataFrame([], schemas.RECIPE_INGREDIENTS),
    }


class Load:
    """A load of staged records (M4 columns and a unique `path`) on top of the stored tables.

    The attributes are the complete new state of the four tables and the status of every record; each
    is planned only when it is used.  `cut` may materialise the cleaned records, the decisions and the new
    rows (for example with a checkpoint), so that writing the tables one after the other does not repeat them.
    """

    def __init__(
        self,
        staged: DataFrame,
        tables: dict[str, DataFrame],
        now: Column | None = None,
        cut: Callable[[DataFrame], DataFrame] = lambda df: df,
    ):
        self.tables = tables
        self.now = F.current_timestamp() if now is None else now
        self.cut = cut
        self.candidates = cut(clean_staged(staged))
        self.decided = cut(decide_titles(self.candidates, tables["recipes"], cut))

    @cached_property
    def new_rows(self) -> DataFrame:
        """Cleaned records that become recipes, with their new ids."""
        accepted = self.decided.where("state = 'loaded'").select(
            F.col("first_path").alias("path"), F.col("recipe_id").alias("id")
        )
        return self.cut(self.candidates.join(accepted, "path"))  # both sides unique on path

    @cached_property
    def new_recipes(self) -> DataFrame:
        made = {c: F.col(c) for c in ["id", *self.candidates.columns]}
        made |= {"created_at": self.now, "updated_at": self.now}
        return self.new_rows.select(
            *[made.get(c, F.lit(None)).cast(t).alias(c) for c, t in self.tables["recipes"].dtypes]
        )

    @cached_property
    def _linked(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return link_lines(
            kept_lines(self.new_rows), self.tables["ingredients"], self.tables["measurements"], self.now
        )

    def new_tables(self) -> dict[str, DataFrame]:
        """Only the rows that the load adds, to be appended."""
        ingredients, measurements, bridge = self._linked
        return {
            "recipes": self.new_recipes,
            "ingredients": ingredients,
            "measurements": measurements,
            "recipe_ingredients": bridge,
        }

    @property
    def recipes(self) -> DataFrame:
        return self.tables["recipes"].unionByName(self.new_recipes)

    @property
    def ingredients(self) -> DataFrame:
        return self.tables["ingredients"].unionByName(self._linked[0])

    @property
    def measurements(self) -> DataFrame:
        return self.tables["measurements"].unionByName(self._linked[1])

    @property
    def recipe_ingredients(self) -> DataFrame:
        return self.tables["recipe_ingredients"].unionByName(self._linked[2])

    @cached_property
    def status(self) -> DataFrame:
        return load_status(self.candidates, self.decided)

    def as_tables(self) -> dict[str, DataFrame]:
        return {
            "recipes": self.recipes,
            "ingredients": self.ingredients,
            "measurements": self.measurements,
            "recipe_ingredients": self.recipe_ingredients,
        }


def load_report(status: DataFrame) -> DataFrame:
    """Totals of a load."""
    return status.agg(
        F.count("*").alias("totalProcessed"),
        F.count_if(F.col("status") == "loaded").alias("successful"),
        F.count_if(F.col("status") == "exists").alias("alreadyExists"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def first_errors(status: DataFrame, n: int = 10) -> DataFrame:
    """The first errors in path order."""
    return (
        status.where(F.col("error").isNotNull())
        .orderBy("path")
        .limit(n)
        .select("path", "error")
    )


# --- changes -------------------------------------------------------------------------------------------
def update_recipes(recipes: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Partial update by id: values that are set replace the stored ones, null leaves them."""
    fields = [c for c in updates.columns if c != "id"]
    new = updates.select("id", *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_hit"))
    joined = recipes.join(new, "id", "left")
    columns = [
        F.coalesce(F.col(f"_new_{c}").cast(t), F.col(c)).alias(c) if c in fields
        else F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.col(c)
        for c, t in recipes.dtypes
    ]
    return joined.select(*columns)


def replace_lines(bridge: DataFrame, replacements: DataFrame) -> DataFrame:
    """Replace the lines of every recipe that occurs in `replacements` as a set."""
    changed = replacements.select("recipe_id").distinct()
    return bridge.join(changed, "recipe_id", "left_anti").unionByName(replacements)


def delete_recipes(recipes: DataFrame, bridge: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Recipes and bridge rows without the given ids, and per id whether it was there."""
    wanted = ids.select("id").distinct()
    hit = wanted.join(recipes.select("id", F.lit(True).alias("deleted")), "id", "left").fillna(False, ["deleted"])
    return (
        recipes.join(wanted, "id", "left_anti"),
        bridge.join(wanted.select(F.col("id").alias("recipe_id")), "recipe_id", "left_anti"),
        hit,
    )


def violations(
    recipes: DataFrame, ingredients: DataFrame, measurements: DataFrame, bridge: DataFrame
) -> DataFrame:
    """Broken constraints as (rule, key, n): enums, unique keys and foreign keys."""

    def enum(df: DataFrame, c: str, allowed: list[str]) -> DataFrame:
        bad = df.where(F.col(c).isNotNull() & ~F.col(c).isin(allowed))
        return bad.groupBy(F.lit(f"enum {c}").alias("rule"), F.col(c).alias("key")).agg(F.count("*").alias("n"))

    def unique(df: DataFrame, rule: str, *keys: str) -> DataFrame:
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
        return df.groupBy(F.lit(f"unique {rule}").alias("rule"), key.alias("key")).agg(
            F.count("*").alias("n")
        ).where("n > 1")

    def orphan(c: str, owner: DataFrame) -> DataFrame:
        # count per key first: the anti-join then sees each key once, however often it occurs
        counts = bridge.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("id")).agg(F.count("*").alias("n"))
        return counts.join(owner.select("id"), "id", "left_anti").select(
            F.lit(f"foreign {c}").alias("rule"), F.col("id").cast("string").alias("key"), "n"
        )

    parts = [
        enum(recipes, "difficulty", lexicon.DIFFICULTIES),
        enum(recipes, "meal_type", lexicon.MEAL_TYPES),
        enum(measurements, "unit_type", lexicon.UNIT_TYPES),
        unique(recipes, "uuid", "uuid"),
        unique(ingredients, "ingredient name", "name"),
        unique(measurements, "measurement name", "name"),
        unique(bridge, "bridge", "recipe_id", "ingredient_id", "order_index"),
        orphan("recipe_id", recipes),
        orphan("ingredient_id", ingredients),
        orphan("measurement_id", measurements),
    ]
    return reduce(DataFrame.unionByName, parts)


class Reload(Load):
    """Load the staged records of some uuids again: known titles are updated, others are inserted."""

    def __init__(
        self,
        staged: DataFrame,
        uuids: DataFrame,
        tables: dict[str, DataFrame],
        now: Column | None = None,
        cut: Callable[[DataFrame], DataFrame] = lambda df: df,
    ):
        # a uuid that many staged records share is cut into slices
        self.chosen = hot_key_join(staged, uuids.select("uuid").distinct(), "uuid", "left_semi")
        super().__init__(self.chosen, tables, now, cut)

    @cached_property
    def drift(self) -> DataFrame:
        """Staged uuid next to the one the title gives today."""
        today = recipe_uuid(F.col("title"))
        return self.chosen.select(
            "path", "title", "uuid", today.alias("current_uuid"), (F.col("uuid") != today).alias("drift")
        )

    @cached_property
    def _updates(self) -> DataFrame:
        """The last staged record of every title that is stored already, under the stored id."""
        valid = self.candidates.where(F.col("problem").isNull())
        last = valid.groupBy("title").agg(F.max("path").alias("path"))
        known = last.join(self.tables["recipes"].select("id", "title"), "title").select("id", "path")
        return valid.join(known, "path")  # both sides unique on path

    @property
    def recipes(self) -> DataFrame:
        fields = ["id", *[c for c in self.tables["recipes"].columns if c in self.candidates.columns and c != "uuid"]]
        return update_recipes(super().recipes, self._updates.select(*fields), self.now)

    @cached_property
    def _linked(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        rows = self.new_rows.select("id", "lines").unionByName(self._updates.select("id", "lines"))
        return link_lines(kept_lines(rows), self.tables["ingredients"], self.tables["measurements"], self.now)

    @property
    def recipe_ingredients(self) -> DataFrame:
        return replace_lines(self.tables["recipe_ingredients"], self._linked[2])


def load_recipes(staged: DataFrame, tables: dict[str, DataFrame], now: Column | None = None, **options) -> Load:
    return Load(staged, tables, now, **options)


def reload_recipes(
    staged: DataFrame, uuids: DataFrame, tables: dict[str, DataFrame], now: Column | None = None, **options
) -> Reload:
    return Reload(staged, uuids, tables, now, **options)
