"""talkmill: a Spark-first engine for speaker-labelled transcript corpora."""
