"""A logistic model given by its coefficients, as a pipeline that can be saved, published and applied."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler

_OUTCOMES = ["_early", "_late"]


def numbering(labels: dict[str, list[str]], index: dict[str, str]) -> list[StringIndexerModel]:
    """Stages that number the tokens of each column; unknown ones get the number after the last."""
    return [
        StringIndexerModel.from_labels(listed, inputCol=name, outputCol=index[name], handleInvalid="keep")
        for name, listed in labels.items()
    ]


class LinearModel(NamedTuple):
    """Coefficients of numeric columns and of the tokens of categorical ones; other tokens count nothing."""

    intercept: float
    numeric: dict[str, float]
    tokens: dict[str, dict[str, float]]

    def margin(self, index: dict[str, str]) -> str:
        """SQL of the margin; ``index`` names the column with each category's token number."""
        terms = [f"{float(self.intercept)!r}D", *[f"{float(c)!r}D * `{name}`" for name, c in self.numeric.items()]]
        for name, coefficients in self.tokens.items():
            listed = ", ".join(f"{float(c)!r}D" for c in (*coefficients.values(), 0.0))  # the last is for unknown tokens
            terms.append(f"element_at(array({listed}), CAST(`{index[name]}` AS INT) + 1)")
        return " + ".join(terms)

    def pipeline(self) -> PipelineModel:
        """Adds ``probability`` (of 0 and of 1) to rows with the model's columns.

        Tokens become numbers and the coefficient is read from a constant array, so a row costs the
        same whatever the size of the vocabulary.
        """
        index = {name: f"{name}_index" for name in self.tokens}
        stages = numbering({name: list(coefficients) for name, coefficients in self.tokens.items()}, index)
        early, late = _OUTCOMES
        odds = f"1D / (1D + exp(-({self.margin(index)})))"
        stages += [
            SQLTransformer(statement=f"SELECT *, 1D - {late} AS {early} FROM (SELECT *, {odds} AS {late} FROM __THIS__)"),
            VectorAssembler(inputCols=_OUTCOMES, outputCol="probability"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join([*_OUTCOMES, *index.values()])}) FROM __THIS__"),
        ]
        return PipelineModel(stages=stages)
