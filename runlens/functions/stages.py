"""Progress figures and labels of a stage, from its counters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The wording of labels.
CALL_SITE_MARK = " at "
FINISHED = "done"
OF = "% of "
ONE_TASK = " task"
MANY_TASKS = " tasks"
ON_GOING = " on-going"
PLUS = " + "
OUT_OF = " / "


def _pct(part: Column, whole: Column) -> Column:
    """Rounded percent, halves up; 0 for a stage without tasks."""
    share = F.try_divide(F.lit(100.0) * part, whole.cast("double"))
    return F.coalesce(F.floor(share + F.lit(0.5)).cast("int"), F.lit(0))


def ongoing(started: Column, done: Column) -> Column:
    return started - done


def done_pct(done: Column, num_tasks: Column) -> Column:
    return _pct(done, num_tasks)


def ongoing_pct(started: Column, done: Column, num_tasks: Column) -> Column:
    return _pct(started - done, num_tasks)


def text_label(
    name: Column, num_tasks: Column, started: Column, done: Column, finished: Column
) -> Column:
    """``name (done)`` or ``name (P% of N tasks, K on-going)``."""
    running = started - done
    counts = F.concat(
        done_pct(done, num_tasks).cast("string"),
        F.lit(OF),
        num_tasks.cast("string"),
        F.when(num_tasks <= 1, F.lit(ONE_TASK)).otherwise(F.lit(MANY_TASKS)),
        F.when(running > 0, F.concat(F.lit(", "), running.cast("string"), F.lit(ON_GOING)))
        .otherwise(F.lit("")),
    )
    state = F.when(finished, F.lit(FINISHED)).otherwise(counts)
    return F.concat(name, F.lit(" ("), state, F.lit(")"))


def bar_label(num_tasks: Column, started: Column, done: Column) -> Column:
    """``D / N``, or ``D + K / N`` while K tasks are on-going."""
    running = started - done
    extra = F.when(running == 0, F.lit("")).otherwise(
        F.concat(F.lit(PLUS), running.cast("string"))
    )
    return F.concat(done.cast("string"), extra, F.lit(OUT_OF), num_tasks.cast("string"))


def stage_action(name: Column, mark: str = CALL_SITE_MARK) -> Column:
    """The part of a stage name before the first mark; the whole name without one."""
    return F.substring_index(name, mark, 1)


def call_site(name: Column, mark: str = CALL_SITE_MARK) -> Column:
    """The part of a stage name after the first mark; null without one."""
    at = F.instr(name, F.lit(mark))
    return F.when(at > 0, F.substring(name, at + F.lit(len(mark)), F.length(name)))


def stage_title_html(name: Column, mark: str = CALL_SITE_MARK) -> Column:
    """Stage name as markup: action and call site as code, text escaped."""
    from runlens.functions.cells import html_escape

    def code(text: Column) -> Column:
        return F.concat(F.lit("<code>"), html_escape(text), F.lit("</code>"))

    site = call_site(name, mark)
    tail = F.when(site.isNotNull(), F.concat(F.lit(mark), code(site))).otherwise(F.lit(""))
    return F.concat(code(stage_action(name, mark)), tail)
