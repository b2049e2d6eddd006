"""Operations for large training-data pipelines; nothing else in lexmill imports this package."""
