"""Training-data operators: licence scan, quality, decontamination, mixing, near and exact
de-duplication, language-model scores, chat formatting, toxicity and token counts."""
