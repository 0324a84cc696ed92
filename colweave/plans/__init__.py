"""Models, model selection and whole fit-and-score plans."""
