"""SVG drawings of the sweep, built from rows as few as the result grid.

One panel per carrier definition, one below the other; ticks and colours follow from the data.
Fixed values: the ``data-*`` attributes, the titles and the labels.
"""

from __future__ import annotations

import math
from html import escape

from tailfold import files

PANEL_SIZE = (960, 340)
MARGIN = {"left": 70, "right": 30, "above": 48, "below": 46}
LEGEND_HEIGHT = 30
TICKS = 6
TITLES = {"any_lof": "Any LoF / HC_or_LC"}
INK, FAINT = "black", "lightgray"


def even_ticks(low: float, high: float, whole: bool = False) -> list[float]:
    """About TICKS round numbers between the bounds."""
    raw = (high - low) / TICKS or 1
    unit = 10.0 ** math.floor(math.log10(raw))
    step = next(m * unit for m in (1, 2, 5, 10) if m * unit >= raw)
    step = max(1, round(step)) if whole else step
    return [step * i for i in range(math.ceil(low / step), math.floor(high / step) + 1)]


def ratio_ticks(low: float, high: float) -> list[float]:
    """1, 3 and 10 times powers of ten between the bounds."""
    powers = range(math.floor(math.log10(low)), math.ceil(math.log10(high)) + 1)
    return [v for p in powers for v in (10.0 ** p, 3 * 10.0 ** p) if low <= v <= high]


def hue(place: int, of: int) -> str:
    return f"hsl({round(300 * place / max(1, of))},65%,42%)"


def element(tag: str, content: str | None = None, **attributes) -> str:
    shown = "".join(
        f' {name.replace("_", "-")}="{escape(f"{v:.6g}" if isinstance(v, float) else str(v))}"'
        for name, v in attributes.items())
    return f"<{tag}{shown}/>" if content is None else f"<{tag}{shown}>{escape(content)}</{tag}>"


class Panel:
    """One chart at a vertical offset; positions come from its two scales."""

    def __init__(self, top: float, xs, ys, log_y: bool):
        self.box = (MARGIN["left"], top + MARGIN["above"], PANEL_SIZE[0] - MARGIN["right"],
                    top + PANEL_SIZE[1] - MARGIN["below"])
        self.xs, self.ys, self.log_y = xs, ys, log_y
        left, upper, right, lower = self.box
        self.parts = [element("path", d=f"M{left} {upper}V{lower}H{right}", fill="none", stroke=INK)]

    def at(self, x: float, y: float) -> tuple[float, float]:
        left, upper, right, lower = self.box
        (x0, x1), (y0, y1) = self.xs, self.ys
        if self.log_y:
            y, y0, y1 = math.log(y), math.log(y0), math.log(y1)
        return (left + (right - left) * (x - x0) / ((x1 - x0) or 1),
                lower - (lower - upper) * (y - y0) / ((y1 - y0) or 1))

    def text(self, x: float, y: float, content: str, **attributes) -> None:
        self.parts.append(element("text", content, x=float(x), y=float(y), fill=INK,
                                  font_family="sans-serif", font_size=12, **attributes))

    def axes(self, title: str, y_label: str, y_ticks) -> None:
        left, upper, right, lower = self.box
        self.text(left, upper - 28, title, font_weight="bold")
        self.text(left, upper - 10, y_label)
        self.text(right, lower + 36, "Number of PCs included (k)", text_anchor="end")
        for tick in even_ticks(*self.xs, whole=True):
            self.text(self.at(tick, self.ys[0])[0], lower + 18, f"{tick:,.0f}", text_anchor="middle")
        for tick in y_ticks:
            self.level(tick, FAINT)
            self.text(left - 8, self.at(self.xs[0], tick)[1] + 4, f"{tick:g}", text_anchor="end")

    def level(self, value: float, color: str, **attributes) -> None:
        left, _, right, _ = self.box
        y = self.at(self.xs[0], value)[1]
        self.parts.append(element("line", x1=left, x2=right, y1=y, y2=y, stroke=color, **attributes))

    def mark(self, count: int, label: str, row: int, **data) -> None:
        """A vertical line at a PC count with its label beside it."""
        _, upper, right, lower = self.box
        x = self.at(count, self.ys[0])[0]
        self.parts.append(element("line", x1=x, x2=x, y1=upper, y2=lower, stroke=INK,
                                  stroke_dasharray="2 3", **data))
        beyond = x > (self.box[0] + right) / 2
        self.text(x - 6 if beyond else x + 6, upper + 14 * (row + 1), label,
                  text_anchor="end" if beyond else "start")

    def curve(self, points, color: str, width: float, **data) -> None:
        if points:
            path = " ".join("{:.6g},{:.6g}".format(*self.at(*p)) for p in sorted(points))
            self.parts.append(element("polyline", points=path, fill="none", stroke=color,
                                      stroke_width=width, **data))


def _offset(index: int) -> float:
    return LEGEND_HEIGHT + index * PANEL_SIZE[1]


def _legend(entries) -> list[str]:
    step = PANEL_SIZE[0] / max(1, len(entries))
    return [part for i, (name, color) in enumerate(entries) for part in (
        element("rect", x=step * i + 10, y=10, width=14, height=10, fill=color),
        element("text", name, x=step * i + 30, y=20, font_family="sans-serif", font_size=12))]


def _write(path, label: str, legend: list[str], panels: list[Panel]) -> None:
    height = _offset(len(panels))
    body = "\n".join([*legend, *(p for panel in panels for p in panel.parts)])
    files.write_text(
        path, f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {PANEL_SIZE[0]} {height}" role="img"'
        f' aria-label="{escape(label)}">\n{body}\n</svg>\n')


def write_selection_svg(path, rows, thresholds, medians, selection) -> None:
    """Odds ratio by PC count: one curve per threshold, the median and the choices."""
    if not rows:
        raise ValueError("no finite positive odds ratios available for the plot")
    ratios = [1.0, *(r.odds_ratio for r in rows), *(m["median_odds_ratio"] for m in medians)]
    counts = [r.pc_count for r in rows]
    xs, ys = (min(counts), max(counts)), (min(ratios) / 1.1, max(ratios) * 1.1)
    colors = {t: hue(i, len(thresholds)) for i, t in enumerate(sorted(thresholds, reverse=True))}
    panels = []
    for index, definition in enumerate(selection["carrier_definitions"]):
        panel = Panel(_offset(index), xs, ys, log_y=True)
        panel.axes(TITLES.get(definition, definition), "Odds ratio (log scale)", ratio_ticks(*ys))
        panel.level(1.0, INK, stroke_dasharray="6 6")
        for threshold, color in colors.items():
            panel.curve([(r.pc_count, r.odds_ratio) for r in rows
                         if (r.carrier_definition, r.z_threshold) == (definition, threshold)],
                        color, 1.5, data_z_threshold=f"{threshold:g}")
        panel.curve([(m["pc_count"], m["median_odds_ratio"]) for m in medians
                     if m["carrier_definition"] == definition],
                    INK, 2.5, data_median_log_or=definition)
        own = selection["minimum_pc_count_within_plateau_by_definition"][definition]
        common = selection["selected_pc_count"]
        panel.mark(own, f"plateau K={own:,}", 0, data_definition_selection_pc=own)
        panel.mark(common, f"selected K={common:,}", 1, data_selection_pc=common)
        panels.append(panel)
    named = [(f"z <= {t:g}", c) for t, c in colors.items()]
    _write(path, "LoF enrichment across principal components",
           _legend([*named, ("median logOR", INK)]), panels)


def write_sweep_svg(path, rows) -> None:
    """Percent of the maximum median odds ratio by PC count, up to the maximum."""
    shown = [r for r in rows if r.pc_count <= r.maximum_pc]
    panels = []
    for index, definition in enumerate(dict.fromkeys(r.carrier_definition for r in shown)):
        own = sorted((r for r in shown if r.carrier_definition == definition),
                     key=lambda r: r.pc_count)
        best = own[-1].maximum_pc
        panel = Panel(_offset(index), (own[0].pc_count, best), (0.0, 110.0), log_y=False)
        panel.axes(definition, "Median enrichment as percent of maximum", even_ticks(0, 100))
        panel.level(95.0, INK, stroke_dasharray="6 6")
        panel.curve([(r.pc_count, r.percent_of_maximum) for r in own], hue(0, 1), 1.5)
        for r in own[::max(1, len(own) // TICKS)]:
            if r.percent_of_maximum < 100:
                x, y = panel.at(r.pc_count, r.percent_of_maximum)
                panel.text(x, y - 6, f"OR = {r.median_odds_ratio:.1f}")
        panel.mark(best, f"maximum PC = {best}, OR = {own[0].maximum_median_odds_ratio:.1f} (100%)", 0,
                   data_maximum_pc=best)
        panels.append(panel)
    _write(path, "Percent of maximum enrichment", [], panels)
