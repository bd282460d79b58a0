"""Detection, scoring, alert, feature, model, evaluation and report operators."""
