"""Table operators: ``DataFrame -> DataFrame``, batch and stream alike."""
