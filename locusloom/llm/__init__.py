"""Operations of a training-data pipeline on DataFrames of documents; nothing else in the library imports them."""
