"""Fixed values.

These must equal the values of the original programs for results to match;
they are parameters everywhere else (every operator takes them as arguments
with these as defaults).
"""

# --- fixed values: the ordered term list (position is meaningful) ----------
LANGS = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# --- fixed values: clustering parameters -----------------------------------
LANG_SPREAD = 50000          # distance between adjacent languages on the x axis
KMEANS_KERNELS = 45          # number of clusters
KMEANS_ETA = 20.0            # converged when the total squared shift < eta
KMEANS_MAX_ITERATIONS = 120  # at most this many mean updates
SAMPLE_SEED = 42             # seed of the global sample
GLOBAL_SAMPLE_BELOW_SPREAD = 500  # spread < 500 -> global sample, else stratified

# The nearest-centre search starts from this bound with a strict "<": a point
# at squared distance >= this from every centre is put in cluster 0.
DISTANCE_CAP = 2147483647

# --- fixed values: article line layout -------------------------------------
ARTICLE_MARKER = "</title><text>"
ARTICLE_PREFIX_LEN = 14   # characters dropped before the title
ARTICLE_SUFFIX_LEN = 16   # characters dropped after the text

# --- fixed values: cluster report text ---------------------------------------
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_LINE_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
