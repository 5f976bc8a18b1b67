"""Schemas of the raw, staged and normalised data."""

from __future__ import annotations

POST_COLUMNS = ["date", "num_comments", "title", "user", "comment", "n_char"]

INGREDIENT = "struct<item: string, amount: string, notes: string>"
INSTRUCTION = "struct<step: int, title: string, description: string>"

EXTRACTED = f"""title string, description string, ingredients array<{INGREDIENT}>,
  instructions array<{INSTRUCTION}>, prepTime string, cookTime string, chillTime string, panSize string,
  difficulty string, cuisine string, mealType string, dietaryTags array<string>"""
EXTRACTED_COLUMNS = [
    "title", "description", "ingredients", "instructions", "prepTime", "cookTime", "chillTime", "panSize",
    "difficulty", "cuisine", "mealType", "dietaryTags",
]

STAGED = f"uuid string, {EXTRACTED}"

RECIPES = """id bigint, uuid string, title string, description string, instructions array<string>,
  prep_time_minutes int, cook_time_minutes int, total_time_minutes int, servings decimal(10,2),
  difficulty string, cuisine_type string, meal_type string, dietary_tags array<string>, source_url string,
  reddit_post_id string, reddit_author string, reddit_score int, reddit_comments_count int,
  created_at timestamp, updated_at timestamp"""

INGREDIENTS = "id bigint, name string, category string, description string, created_at timestamp, updated_at timestamp"

MEASUREMENTS = "id bigint, name string, abbreviation string, unit_type string, created_at timestamp, updated_at timestamp"

RECIPE_INGREDIENTS = """recipe_id bigint, ingredient_id bigint, measurement_id bigint, amount decimal(10,3),
  notes string, order_index int, created_at timestamp"""

EVENT = "date string, num_comments string, title string, user string, comment string, n_char string"
EVENT_METADATA = "struct<source: string, version: string>"
