"""Prompt vocabularies, in our own words; a prompt is picked by a row's key, so that every run picks the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ASK = ("Please {}", "{}", "Kindly {}", "Could you {}?", "Your task: {}")
_ASK_TOO = (*_ASK, "I need you to {}")


def _asked(ways: tuple[str, ...], *wishes: str) -> tuple[str, ...]:
    """Every wish in every way of asking; a wish may have a {} slot of its own."""
    return tuple(a.replace("{}", v, 1) for v in wishes for a in ways)


#: As many entries as users of each list rely on: 48, 20, 20, 20, 10, 10.
PROMPTS: dict[str, tuple[str, ...]] = {
    "ocr": _asked(
        _ASK_TOO, "read all the text in this picture", "write down every word you can see here", "copy out the text shown", "transcribe the image", "list the lines of text in the picture", "extract the writing from this image",
        "tell me what the text in the photo says", "type up what is printed here",
    ),
    "ocr_markdown": _asked(_ASK, "turn this page into Markdown", "give the page's content as Markdown, in reading order", "rewrite the document shown as Markdown", "convert the picture's text to Markdown, headings and lists included"),
    "latex_ocr": _asked(_ASK, "write this formula as LaTeX", "give the LaTeX source of what is shown", "typeset the expression in the image as LaTeX", "turn the equation in the picture into LaTeX code"),
    "table_html": _asked(_ASK, "rebuild this table as HTML", "give the table's HTML markup", "write the rows and columns shown as an HTML table", "convert the table in the picture to HTML"),
    "box_en": _asked(_ASK, "find {} and give its box", "say where {} is in the image"),
    "box_zh": tuple(a.replace("~", v) for v in ("给出{}的边界框", "标出{}在图中的位置") for a in ("请~", "~", "麻烦~", "你能~吗？", "任务：~")),
    "video_caption_en": _asked(_ASK, "describe this video", "tell what happens in the clip"),
}


def pick(key: Column, name: str, slot: Column | None = None) -> Column:
    """The prompt for an integer key, its {} slot filled in."""
    choices = PROMPTS[name]
    text = F.element_at(F.array(*map(F.lit, choices)), (F.pmod(key, F.lit(len(choices))) + 1).cast("int"))
    return F.replace(text, F.lit("{}"), slot) if slot is not None else text
