"""Vocabularies of the rating data."""

# index = position in the list, starting at 1; 0 is padding or unknown.
GENRES = [
    "Action",
    "Adventure",
    "Animation",
    "Children's",
    "Comedy",
    "Crime",
    "Documentary",
    "Drama",
    "Fantasy",
    "Film-Noir",
    "Horror",
    "Musical",
    "Mystery",
    "Romance",
    "Sci-Fi",
    "Thriller",
    "War",
    "Western",
]

# Ages with their own bucket, in bucket order; any other age falls into the next bucket.
AGE_BUCKETS = [1, 18, 25, 35, 45, 50]

# Label of each time-of-day slot.
TIME_SLOT_LABELS = {
    0: "Matinee (6:00-17:59)",
    1: "Prime Time (18:00-21:59)",
    2: "Late Night (22:00-5:59)",
}

# Columns of the classifier and its label.
FEATURE_COLS = ["gender_idx", "age_idx", "occupation", "target_time"]
TARGET_COL = "target"
