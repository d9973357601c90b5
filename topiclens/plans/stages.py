"""``pyspark.ml`` stages for the operators, so they compose in a ``Pipeline`` and save/load.

Stateless steps are ``Transformer``s.  Steps that learn something from the data are
``Estimator``s whose models keep what was learnt (vocabulary and document frequencies,
visual-word centroids, per-word document frequencies), so training and new data share the
same weights.  What a model has learnt is a table, not a parameter: it is read by Spark, never
collected, and saved as Parquet beside the stage's parameters (``_TableModel``).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorSlicer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, \
    MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import image as IM
from ..functions import text as TX
from ..operators import cleaning as CL
from ..operators import clusters as CU
from ..operators import images as IO
from ..operators import vocabulary as VO
from ..session import materialize
from ..sources import readers as RD


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    def _set_kw(self, kwargs):
        return self._set(**{k: v for k, v in kwargs.items() if v is not None})


class _TableWriter(MLWriter):
    """Parameters as metadata, the learnt table as Parquet in ``table``."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.cls()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found.with_table(self.sparkSession.read.parquet(f"{path}/table"))


class _TableModel(Model, _Stage):
    """A model whose state is a table of any size."""

    table: DataFrame

    def with_table(self, table: DataFrame):
        self.table = table
        return self

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _ColumnTransformer(Transformer, HasInputCol, HasOutputCol, _Stage):
    def _col(self) -> F.Column:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self._col())


class LowerStrip(_ColumnTransformer):
    """T1 on a text column."""

    @keyword_only
    def __init__(self, inputCol="text", outputCol="text"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="text")
        self._set_kw(self._input_kwargs)

    def _col(self):
        return TX.lower_strip(self.getInputCol())


class UrlRemover(_ColumnTransformer):
    """T2 on a text column."""

    @keyword_only
    def __init__(self, inputCol="text", outputCol="text"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="text")
        self._set_kw(self._input_kwargs)

    def _col(self):
        return TX.remove_url(self.getInputCol())


class EscapeRemover(_ColumnTransformer):
    """T3 on a text column."""

    @keyword_only
    def __init__(self, inputCol="text", outputCol="text"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="text")
        self._set_kw(self._input_kwargs)

    def _col(self):
        return TX.remove_escapes(self.getInputCol())


class RegexTokens(_ColumnTransformer):
    """All matches of ``pattern``."""

    pattern = Param(Params._dummy(), "pattern", "token regex", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="text", outputCol="tokens", pattern=TX.DEFAULT_TOKEN_PATTERN):
        super().__init__()
        self._setDefault(pattern=TX.DEFAULT_TOKEN_PATTERN, inputCol="text", outputCol="tokens")
        self._set_kw(self._input_kwargs)

    def _col(self):
        return TX.tokenize(self.getInputCol(), self.getOrDefault(self.pattern))


class RepeatedCharCorrector(Transformer, _Stage):
    """Correct words with a letter repeated 3+ times against a vocabulary table
    (parquet with a ``term`` column) and an optional lexicon table."""

    vocabularyPath = Param(Params._dummy(), "vocabularyPath", "parquet of known terms", TypeConverters.toString)
    lexiconPath = Param(Params._dummy(), "lexiconPath", "parquet (token, lemma, pos)", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row key", TypeConverters.toString)

    @keyword_only
    def __init__(self, vocabularyPath=None, lexiconPath=None, textCol="text", idCol="doc_id"):
        super().__init__()
        self._setDefault(textCol="text", idCol="doc_id")
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        spark = df.sparkSession
        vocab = spark.read.parquet(self.getOrDefault(self.vocabularyPath))
        lex = spark.read.parquet(self.getOrDefault(self.lexiconPath)) if self.isSet(self.lexiconPath) else None
        return CL.correct_repeated(df, vocab, lex, self.getOrDefault(self.textCol), self.getOrDefault(self.idCol))


DEFAULT_POS = ["NOUN", "ADJ"]


class TokenCleaner(Transformer, _Stage):
    """T8 on ``(doc_id, tokens)``: returns ``(doc_id, tokens, text)`` of the kept lemmas.

    Parts of speech come from the lexicon: with one, ``posToKeep`` is nouns and adjectives by default.  Without
    one no token has a part of speech, so nothing is filtered by it, and asking for ``posToKeep`` is an error."""

    stopWords = Param(Params._dummy(), "stopWords", "stop words", TypeConverters.toListString)
    customStopWords = Param(Params._dummy(), "customStopWords", "lemmas to drop", TypeConverters.toListString)
    posToKeep = Param(Params._dummy(), "posToKeep", "parts of speech kept", TypeConverters.toListString)
    lexiconPath = Param(Params._dummy(), "lexiconPath", "parquet (token, lemma, pos)", TypeConverters.toString)

    @keyword_only
    def __init__(self, stopWords=None, customStopWords=None, posToKeep=None, lexiconPath=None):
        super().__init__()
        self._setDefault(stopWords=list(TX.ENGLISH_STOP_WORDS), customStopWords=[])
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        spark = df.sparkSession
        lex = spark.read.parquet(self.getOrDefault(self.lexiconPath)) if self.isSet(self.lexiconPath) else None
        custom = self.getOrDefault(self.customStopWords)
        wanted = self.getOrDefault(self.posToKeep) if self.isSet(self.posToKeep) else []
        if lex is None and wanted:
            raise ValueError("posToKeep needs a lexicon (lexiconPath) that gives the parts of speech")
        if lex is None:  # no lemmas or parts of speech: filter each token array in place
            kept = CL.clean_token_arrays(df.select("doc_id", "tokens"), "tokens",
                                         self.getOrDefault(self.stopWords), custom)
            return kept.select("doc_id", "tokens", F.array_join("tokens", " ").alias("text"))
        kept = CL.clean_tokens(VO.explode_tokens(df.select("doc_id", "tokens")),
                               CL.word_table(spark, self.getOrDefault(self.stopWords)), lex,
                               wanted if self.isSet(self.posToKeep) else DEFAULT_POS,
                               CL.word_table(spark, custom) if custom else None)
        back = VO.collect_tokens(kept)
        return df.select("doc_id").join(back, "doc_id", "left").select(
            "doc_id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"),
            F.coalesce("text", F.lit("")).alias("text"))


class CorpusVectorizer(Estimator, _Stage):
    """A1-A4: ``fit`` builds the filtered vocabulary; the model turns ``(doc_id, tokens)``
    into long ``(doc_id, term_id, tf)`` or ``(doc_id, term_id, weight)`` rows."""

    noBelow = Param(Params._dummy(), "noBelow", "min document frequency", TypeConverters.toInt)
    noAbove = Param(Params._dummy(), "noAbove", "max document share", TypeConverters.toFloat)
    keepN = Param(Params._dummy(), "keepN", "max vocabulary size", TypeConverters.toInt)
    smartirs = Param(Params._dummy(), "smartirs", "SMART weighting code", TypeConverters.toString)
    applyTfidf = Param(Params._dummy(), "applyTfidf", "weights instead of counts", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, noBelow=0, noAbove=1.0, keepN=100_000, smartirs="nfc", applyTfidf=False):
        super().__init__()
        self._setDefault(noBelow=0, noAbove=1.0, keepN=100_000, smartirs="nfc", applyTfidf=False)
        self._set_kw(self._input_kwargs)

    def _fit(self, df):
        counts = VO.term_counts(df)
        n = df.count()
        vocab = VO.filter_extremes(VO.build_vocabulary(counts), n, self.getOrDefault(self.noBelow),
                                   self.getOrDefault(self.noAbove), self.getOrDefault(self.keepN))
        kept = materialize(vocab.select("term", "term_id", "df"), "vocabulary")
        return CorpusVectorizerModel(nDocs=n, nTerms=kept.count(), smartirs=self.getOrDefault(self.smartirs),
                                     applyTfidf=self.getOrDefault(self.applyTfidf)).with_table(kept)


class CorpusVectorizerModel(_TableModel):
    """``table``: the vocabulary ``(term, term_id, df)``."""

    nDocs = Param(Params._dummy(), "nDocs", "documents seen by fit", TypeConverters.toInt)
    nTerms = Param(Params._dummy(), "nTerms", "size of the vocabulary", TypeConverters.toInt)
    smartirs = Param(Params._dummy(), "smartirs", "SMART weighting code", TypeConverters.toString)
    applyTfidf = Param(Params._dummy(), "applyTfidf", "weights instead of counts", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, nDocs=None, nTerms=None, smartirs="nfc", applyTfidf=False):
        super().__init__()
        self._setDefault(smartirs="nfc", applyTfidf=False)
        self._set_kw(self._input_kwargs)

    def vocabulary(self) -> DataFrame:
        return self.table

    def terms(self) -> list[str]:
        """The vocabulary in id order, on the driver (at most ``keepN`` strings)."""
        return [r["term"] for r in self.table.orderBy("term_id").select("term").collect()]

    def _transform(self, df):
        size = self.getOrDefault(self.nTerms)
        bow = VO.bag_of_words(VO.term_counts(df), self.table, size)
        if not self.getOrDefault(self.applyTfidf):
            return bow
        return VO.tfidf(bow, self.table, self.getOrDefault(self.nDocs), self.getOrDefault(self.smartirs), size)


class PhotoMetaLoader(Transformer, _Stage):
    """S3: add ``photo_path`` = ``<photosDir>/<photo_id>.jpg``."""

    photosDir = Param(Params._dummy(), "photosDir", "photo folder", TypeConverters.toString)

    @keyword_only
    def __init__(self, photosDir="/data/photos"):
        super().__init__()
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        return RD.with_photo_path(df, self.getOrDefault(self.photosDir))


class ImagesLoader(Transformer, _Stage):
    """S5 + I7: the photos' decoded images as rows ``(image_id, height, width, n_channels, pixels)``.

    ``image_id`` is the file stem of the photo; photos without a readable file have no row."""

    photosDir = Param(Params._dummy(), "photosDir", "photo folder", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "file name ending", TypeConverters.toString)

    @keyword_only
    def __init__(self, photosDir=None, suffix=".jpg"):
        super().__init__()
        self._setDefault(suffix=".jpg")
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        files = RD.load_images(df.sparkSession, self.getOrDefault(self.photosDir))
        rows = files.select(RD.file_stem(RD.base_name("origin"), self.getOrDefault(self.suffix)).alias("image_id"),
                            "height", "width", "n_channels", IM.image_bytes_to_array("data").alias("pixels"))
        return rows.join(df.select(F.col("photo_id").cast("string").alias("image_id")).distinct(), "image_id", "left_semi")


class StratifiedSampler(Transformer, HasSeed, _Stage):
    """J2 + W1: photos whose file is in ``photosDir`` (when set), then n per label."""

    nPerLabel = Param(Params._dummy(), "nPerLabel", "rows per label (0: all)", TypeConverters.toInt)
    photosDir = Param(Params._dummy(), "photosDir", "photo folder to list", TypeConverters.toString)

    @keyword_only
    def __init__(self, nPerLabel=0, photosDir=None, seed=16):
        super().__init__()
        self._setDefault(nPerLabel=0, seed=16)
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        files = RD.list_files(df.sparkSession, self.getOrDefault(self.photosDir)) \
            if self.isSet(self.photosDir) else None
        return RD.sample_photos(df, files, self.getOrDefault(self.nPerLabel), self.getOrDefault(self.seed))


class RetentionManifest(Transformer, _Stage):
    """The files of ``photosDir`` that are not among the input photos (nothing is deleted)."""

    photosDir = Param(Params._dummy(), "photosDir", "photo folder to list", TypeConverters.toString)

    @keyword_only
    def __init__(self, photosDir=None):
        super().__init__()
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        files = RD.list_files(df.sparkSession, self.getOrDefault(self.photosDir))
        return RD.retention_manifest(files, df)


class GrayConverter(Transformer, _Stage):
    """I1 on image rows ``(image_id, height, width, n_channels, pixels)``."""

    inputFormat = Param(Params._dummy(), "inputFormat", "BGR or RGB", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputFormat="BGR"):
        super().__init__()
        self._setDefault(inputFormat="BGR")
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        gray = F.when(F.col("n_channels") == 3, IM.to_gray("pixels", self.getOrDefault(self.inputFormat))) \
            .otherwise(F.col("pixels"))
        return df.withColumn("pixels", gray).withColumn("n_channels", F.lit(1))


class Equalizer(Transformer, _Stage):
    """I2 on gray image rows."""

    def _transform(self, df):
        return IO.equalize_images(df)


class Blurer(Transformer, _Stage):
    """I3 on gray image rows."""

    ksize = Param(Params._dummy(), "ksize", "odd kernel size, or width and height", TypeConverters.toListInt)
    sigma = Param(Params._dummy(), "sigma", "0: from ksize", TypeConverters.toFloat)
    borderType = Param(Params._dummy(), "borderType", "reflect_101 or reflect", TypeConverters.toString)

    @keyword_only
    def __init__(self, ksize=3, sigma=0.0, borderType="reflect_101"):
        super().__init__()
        self._setDefault(ksize=[3, 3], sigma=0.0, borderType="reflect_101")
        given = dict(self._input_kwargs)
        if isinstance(given.get("ksize"), int):
            given["ksize"] = [given["ksize"]] * 2
        self._set_kw(given)

    def _transform(self, df):
        return IO.blur_images(df, self.getOrDefault(self.ksize), self.getOrDefault(self.sigma),
                              self.getOrDefault(self.borderType))


class DescriptorExtractor(Transformer, _Stage):
    """M6 + W9: ``(image_id, desc_ix, energy, descriptor)``; ``nfeatures`` = 0 keeps all."""

    nfeatures = Param(Params._dummy(), "nfeatures", "strongest per image (0: all)", TypeConverters.toInt)
    contrastThreshold = Param(Params._dummy(), "contrastThreshold", "flat-cell cut", TypeConverters.toFloat)
    cell = Param(Params._dummy(), "cell", "cell size in pixels", TypeConverters.toInt)

    @keyword_only
    def __init__(self, nfeatures=0, contrastThreshold=0.04, cell=4):
        super().__init__()
        self._setDefault(nfeatures=0, contrastThreshold=0.04, cell=4)
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        d = IO.extract_descriptors(df, self.getOrDefault(self.cell), 8, self.getOrDefault(self.contrastThreshold))
        return IO.top_descriptors(d, self.getOrDefault(self.nfeatures))


class VisualWords(Estimator, HasSeed, _Stage):
    """M5 + A6: ``fit`` clusters descriptors into visual words; the model gives per-image
    counts ``(image_id, word_id, cnt)``.  An image whose descriptor is null (none was found) keeps
    one row with a null ``word_id`` and count 0."""

    nWords = Param(Params._dummy(), "nWords", "word count, 0 = floor(sqrt(#descriptors))", TypeConverters.toInt)
    nInit = Param(Params._dummy(), "nInit", "KMeans restarts", TypeConverters.toInt)

    @keyword_only
    def __init__(self, nWords=0, nInit=15, seed=16):
        super().__init__()
        self._setDefault(nWords=0, nInit=15, seed=16)
        self._set_kw(self._input_kwargs)

    def _fit(self, df):
        from . import models as MD

        nw = self.getOrDefault(self.nWords) or "sqrt"
        words = MD.visual_dictionary(df, nw, seed=self.getOrDefault(self.seed), n_init=self.getOrDefault(self.nInit))
        return VisualWordsModel().with_table(words.select("word_id", "centroid"))


class VisualWordsModel(_TableModel):
    """``table``: the dictionary ``(word_id, centroid)``."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def centroid_table(self, spark=None) -> DataFrame:
        return self.table

    def _transform(self, df):
        some = df.filter("descriptor is not null")
        assigned = CU.nearest_centroid(some, self.table, "descriptor", round_to=None)
        found = CU.bovw_histogram(assigned)
        empty = df.select("image_id").distinct().join(found.select("image_id").distinct(), "image_id", "left_anti")
        none = empty.select("image_id", F.lit(None).cast(found.schema["word_id"].dataType).alias("word_id"),
                            F.lit(0).cast("long").alias("cnt"))
        return found.unionByName(none)


class TfidfWeighter(Estimator, _Stage):
    """A5: ``fit`` counts images per word and all images, those without a word (null ``word_id``)
    included; the model weights ``(image_id, word_id, cnt)``."""

    def _fit(self, df):
        n = df.select("image_id").distinct().count()
        found = df.filter("word_id is not null").groupBy("word_id").agg(F.count_distinct("image_id").alias("df"))
        return TfidfWeighterModel(nImages=n).with_table(materialize(found, "word_frequencies"))


class TfidfWeighterModel(_TableModel):
    """``table``: images per word ``(word_id, df)``."""

    nImages = Param(Params._dummy(), "nImages", "images seen by fit", TypeConverters.toInt)

    @keyword_only
    def __init__(self, nImages=None):
        super().__init__()
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        return VO.weight_matrix(df, self.table, self.getOrDefault(self.nImages), "nfc", key="image_id", item="word_id",
                                count="cnt", drop_zero=False, broadcast_df=False)


class ScaledPCA(Estimator, _Stage):
    """M1-M2 with a count or a variance fraction: ``fit`` scales by the population std, fits all
    components once and keeps the leading ones; the model is a reusable, saveable pipeline."""

    nComponents = Param(Params._dummy(), "nComponents", "components, or share of variance below 1", TypeConverters.toFloat)
    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "reduced vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, nComponents=0.8, inputCol="features", outputCol="pca"):
        super().__init__()
        self._setDefault(nComponents=0.8, inputCol="features", outputCol="pca")
        self._set_kw(self._input_kwargs)

    def _fit(self, df):
        source, want = self.getOrDefault(self.inputCol), self.getOrDefault(self.nComponents)
        scaler = StandardScaler(withMean=True, withStd=True, inputCol=source, outputCol="_sample_scaled").fit(df)
        n, dim = df.count(), scaler.mean.size
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0  # sample to population standard deviation
        population = ElementwiseProduct(scalingVec=DenseVector([factor] * dim), inputCol="_sample_scaled", outputCol="_scaled")
        pca = PCA(k=dim, inputCol="_scaled", outputCol="_all").fit(population.transform(scaler.transform(df)))
        ratios = pca.explainedVariance.toArray().cumsum()
        k = min(dim, int((ratios < want).sum()) + 1) if want < 1 else min(dim, int(want))
        first = VectorSlicer(inputCol="_all", outputCol=self.getOrDefault(self.outputCol), indices=list(range(k)))
        return PipelineModel(stages=[scaler, population, pca, first])


class ReviewSelector(Transformer, HasSeed, _Stage):
    """S7 on a reviews DataFrame: businesses from a parquet table, category, stars, size."""

    businessPath = Param(Params._dummy(), "businessPath", "parquet (business_id, categories)", TypeConverters.toString)
    category = Param(Params._dummy(), "category", "substring of categories", TypeConverters.toString)
    stars = Param(Params._dummy(), "stars", "kept star values", TypeConverters.toListInt)
    size = Param(Params._dummy(), "size", "sample size", TypeConverters.toInt)
    orderCols = Param(Params._dummy(), "orderCols", "file order of reviews", TypeConverters.toListString)
    keyCol = Param(Params._dummy(), "keyCol", "review key", TypeConverters.toString)
    chunked = Param(Params._dummy(), "chunked", "reproduce the chunked reader", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, businessPath=None, category="restaurant", stars=None, size=1000, orderCols=None,
                 keyCol="review_id", chunked=False, seed=16):
        super().__init__()
        self._setDefault(category="restaurant", size=1000, keyCol="review_id", chunked=False, seed=16)
        self._set_kw(self._input_kwargs)

    def _transform(self, df):
        biz = df.sparkSession.read.parquet(self.getOrDefault(self.businessPath))
        key = self.getOrDefault(self.keyCol)
        order = self.getOrDefault(self.orderCols) if self.isSet(self.orderCols) else [key]
        return RD.select_reviews(biz, df, self.getOrDefault(self.category), self.getOrDefault(self.stars),
                                 self.getOrDefault(self.size), order, F.col(key), self.getOrDefault(self.seed),
                                 chunked=self.getOrDefault(self.chunked))


__all__ = ["LowerStrip", "UrlRemover", "EscapeRemover", "RegexTokens", "RepeatedCharCorrector", "TokenCleaner",
           "CorpusVectorizer", "CorpusVectorizerModel", "PhotoMetaLoader", "StratifiedSampler",
           "RetentionManifest", "GrayConverter", "Equalizer", "Blurer", "DescriptorExtractor", "VisualWords",
           "VisualWordsModel", "TfidfWeighter", "TfidfWeighterModel", "ScaledPCA", "ImagesLoader", "ReviewSelector"]
