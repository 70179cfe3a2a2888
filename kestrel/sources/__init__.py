from kestrel.sources.tables import TABLES, load, trip_text_view, coordinates_view
from kestrel.sources.files import (read_delimited, read_whole_texts, read_pairs, read_tagged, literal_frame,
                                   synthetic_linear, write_table, save_model, load_pipeline_model,
                                   profile_shape, read_dated_series)
