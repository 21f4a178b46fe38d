"""Training-data operators: nearest neighbours, decontamination, sharding, exact and
near de-duplication, mixing, language, quality and toxicity models, chat formatting.

Nothing else in the library imports this subpackage.
"""
