"""Instruction and multiple-choice prompt columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import CHOICE_HEADER, CHOICE_LABELS, PROMPT_WITH_INPUT, PROMPT_WITHOUT_INPUT
from .text import normalize_text, rstrip, strip


def _fill(template: str, **columns: Column) -> Column:
    """Template text with ``{name}`` holes replaced by columns."""
    parts, rest = [], template
    for name, column in columns.items():
        before, rest = rest.split("{" + name + "}")
        parts += [F.lit(before), column]
    return F.concat(*parts, F.lit(rest))


def fixed_text_length(with_input: bool) -> int:
    """Characters a template adds around its fields."""
    if with_input:
        return len(PROMPT_WITH_INPUT) - len("{instruction}{input}")
    return len(PROMPT_WITHOUT_INPUT) - len("{instruction}")


def prompt_without_input(instruction: Column) -> Column:
    return _fill(PROMPT_WITHOUT_INPUT, instruction=instruction)


def prompt_with_input(instruction: Column, context: Column) -> Column:
    return _fill(PROMPT_WITH_INPUT, instruction=instruction, input=context)


def instruction_prompt(instruction: Column, context: Column | None = None) -> Column:
    """Prompt of a record; a blank instruction fails the job."""
    task = normalize_text(instruction)
    if context is None:
        body = prompt_without_input(task)
    else:
        given = normalize_text(F.coalesce(context, F.lit("")))
        body = F.when(F.length(given) > 0, prompt_with_input(task, given)).otherwise(
            prompt_without_input(task)
        )
    return F.when(F.length(task) > 0, body).otherwise(
        F.raise_error(F.lit("instruction cannot be empty"))
    )


def answer_label(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(l) for l in CHOICE_LABELS]), index + 1)


def choice_example(
    question: Column, choices: Column, answer: Column | None = None
) -> Column:
    """One question block; with ``answer`` the label follows ``Answer:``."""
    lines = [strip(question)]
    for position, label in enumerate(CHOICE_LABELS):
        lines.append(F.concat(F.lit(f"{label}. "), strip(F.get(choices, F.lit(position)))))
    closing = F.lit("Answer:")
    if answer is not None:
        closing = F.concat(F.lit("Answer: "), answer_label(answer))
    return F.concat(F.concat_ws("\n", *lines, closing), F.lit("\n\n"))


def choice_header(subject: Column) -> Column:
    return F.concat(
        F.lit(CHOICE_HEADER), F.replace(subject, F.lit("_"), F.lit(" ")), F.lit(".\n\n")
    )


def choice_question(question: Column, choices: Column) -> Column:
    """The question to answer, without trailing blanks."""
    return rstrip(choice_example(question, choices))


def choice_prompt(
    subject: Column, question: Column, choices: Column, shots: Column | None = None
) -> Column:
    """Header, the demonstration texts in ``shots`` (array of blocks), then the question."""
    shown = F.lit("") if shots is None else F.array_join(shots, "")
    return F.concat(choice_header(subject), shown, choice_question(question, choices))


def in_mode(prompt: Column, mode: Column) -> Column:
    """Wrap a question prompt in the instruction template where ``mode`` asks for it."""
    return F.when(mode == "instruction", prompt_without_input(normalize_text(prompt))).otherwise(prompt)


def resolve_mode(requested: Column, training_stage: Column) -> Column:
    """``auto`` follows the training stage: instruction after fine-tuning ('sft')."""
    return F.when(requested != "auto", requested).otherwise(
        F.when(training_stage == "sft", F.lit("instruction")).otherwise(F.lit("completion"))
    )


def answer_continuation(label: Column, mode: Column) -> Column:
    """Text scored for a label: unspaced after an instruction prompt."""
    return F.when(mode == "instruction", label).otherwise(F.concat(F.lit(" "), label))
