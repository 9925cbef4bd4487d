"""Review-sentiment analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers (JSON reviews, score lines, CSV review files, saved models)
  sinks      writers (run reports, score tables)
  functions  column expressions (labels, tokens, stop words, sentences)
  operators  DataFrame -> DataFrame operators (split, features, lexicon, metrics, join)
  plans      ML classifier chains, ablation, run reports, registered checks
  streaming  Structured Streaming scorer for newly arriving review files
"""

__version__ = "0.1.0"
