"""Operations of a training-data pipeline, each a DataFrame -> DataFrame function.

Nothing outside this package imports it; it may import the library's general
helpers.
"""
